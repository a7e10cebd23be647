"""Hard negatives, fill-in-the-middle and quality rules against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
import zstandard

from gridloom.llm import bands, fill_in_middle as fim, negatives, queries

DATA = "/root/testdata/sf0.001"


def oracle(name, tables):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con.sql(queries.ORACLES[name])


@pytest.mark.parametrize("name, table", [("op11_hard_negatives", "embeddings"), ("op12_fill_in_middle", "documents")])
def test_query_equals_its_sql(spark, name, table):
    got, want = queries.QUERIES[name](spark, DATA), oracle(name, [table])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = sorted(map(str, (tuple(r) for r in got.select(*columns).collect())))
    assert rows and rows == sorted(map(str, want.project(", ".join(columns)).fetchall()))


# --- hard negatives


def brute_negatives(rows, every=50, k=5, m=3, low=50, high=95):
    rows = [(i, lab, tuple(int(np.floor(256.0 * x)) for x in v)) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in sorted(rows, key=lambda r: (r[1], r[2])):
        if i % every == 0:
            anchors.setdefault(i, (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other == lab) for i, other, w in rows if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2])[:k]:
            fit = sorted((t, i) for t, i, same in scored if not same and low * -s <= 100 * -t <= high * -s)
            out += [(a, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(fit[:m])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, v string, sq string, chunk string, score string, longest string"


def test_negatives_odd_rows(spark):
    """Nulls, infinities, zero vectors, lengths over four classes, ties, repeated rows, dimensions, a label with most rows, clashing columns."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        v = rng.normal(0, 1, 12) * 10.0 ** rng.integers(-1, 2)
        if i % 9 == 0:
            v = np.round(v)
        rows.append((i, v.tolist(), 0 if i % 3 == 0 else int(i % 5)))
    rows += rows[20:40] + [(50, rows[50][1], 3), (60, rows[61][1], 1)]  # repeated rows, and ids with other content
    rows += [(None, rows[0][1], 0), (800, None, 1), (850, rows[0][1], None), (900, [None] * 12, 1), (901, [float("nan")] * 12, 1), (902, [float("inf")] * 12, 1)]
    rows += [(950 + k, [0.0] * 12, k % 2) for k in range(4)] + [(1000 + k, [1.0 + k / 10, 2.0], k % 2) for k in range(9)] + [(1050, [], 1), (1051, [], 1), (1052, [], 0)]
    rows += [(1100 + k, rows[3][1], k % 2) for k in range(60)]  # equal vectors under two labels
    table = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], VECTORS)
    want = brute_negatives(rows)
    for sizes in ({}, {"block_rows": 16, "chunk_rows": 100, "group_anchors": 4}):
        got = sorted(map(tuple, negatives.hard_negatives(table, **sizes).collect()))
        assert got == want
    assert negatives.hard_negatives(table.limit(0)).count() == 0
    wide = [(k, [2.0**23 + k, float(k)], k % 2) for k in range(120)]  # scores beyond what doubles add exactly
    got = negatives.hard_negatives(spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int"), low=1, high=100)
    assert sorted(map(tuple, got.collect())) == brute_negatives(wide, low=1, high=100)


def test_ranges_prune_and_never_lose():
    rng = np.random.default_rng(6)
    p = rng.normal(size=(2048, 32)).astype(float)
    v = np.floor(256 * p / np.linalg.norm(p, axis=1)[:, None]).astype(np.int64)
    import pyarrow as pa

    part = pa.table({"v": v.tolist(), "sq": (v.astype(float) ** 2).sum(axis=1), "vec_id": np.arange(2048), "label": np.zeros(2048, np.int64)})
    b = negatives._Block(negatives._block(part, 32, 0), np.dtype(float))
    q = v[:40].astype(float)
    unit = q / np.linalg.norm(q, axis=1)[:, None]
    focus = np.argsort(-np.abs(unit), axis=1)[:, : negatives.FOCUS]
    kept = []
    for cosine in (0.4, 0.6, 0.8, 0.9):
        low, high = negatives.ranges(np.full(40, cosine), unit, focus)
        for k in range(40):
            found = set(b.candidates(focus[k].tolist(), low[k].tolist(), high[k].tolist()).tolist())
            assert set(np.flatnonzero(b.unit.T @ unit[k] >= cosine).tolist()) <= found
            kept.append(len(found))
    assert sum(kept) < 0.8 * len(kept) * 2048


# --- fill in the middle


def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), sha(out), sha(text)


FIM_TEXTS = [None, "", "\n", "\n\n", "one", "one\n", "a\nb\nc", "é\nß 漢字\n\n🙂 end", "ends in <\nS>\nnext", "holds <M> mark\nx", "\r\nx\ry\n", "<", "<<\n<S\n>", "x" * 300_000 + "\n" + "y\n" * 50_000]


def test_fill_in_middle_odd(spark):
    rows = [(k if k % 5 else None, t, "c", "d", "e") for k, t in enumerate(FIM_TEXTS * 4)] + [(3, "one\ntwo", "c", "d", "e")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, form string, n string")
    made = fim.fill_in_middle(docs)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = fim.restore(made).collect()
    assert sorted(str(tuple(r[c] for c in columns)) for r in got) == sorted(str(brute_fim(i, t)) for i, t, *_ in rows)
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t, *_ in rows)
    outputs = made.collect()
    assert {r.form for r in outputs} == {"plain", "psm", "spm"}
    assert all(hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256 for r in outputs)
    assert fim.fill_in_middle(docs, rate=0).where("form <> 'plain'").count() == 0
    assert {r.form for r in fim.fill_in_middle(docs, spm=0).collect()} == {"plain", "psm"}
    assert fim.restore(fim.fill_in_middle(docs.limit(0))).count() == 0
    bad = spark.createDataFrame([("psm", "no sentinels"), ("odd", "x"), ("spm", None), (None, "x")], "form string, output string")
    assert all(r.restored is None and r.restored_sha256 is None for r in fim.restore(bad).collect())


def test_piece_table():
    t = fim.PieceTable(b"abcdef").cut(0, 2, 2, 6)
    assert [bytes(x) for x in t] == [b"", b"ab", b"", b"cdef", b""]
    assert t.arranged([3, 1]).cut(4).text() == b"cdefab"
    assert t.arranged([3, 1]).sha256() == hashlib.sha256(b"cdefab").hexdigest()


# --- quality rules


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), len(words) < 20 or 100 * len(repeated) > 30 * len(words)


def prose(n, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(600)]
    return ". ".join(" ".join(rng.choice(vocabulary, 12)) for _ in range(n // 12))


def test_quality_rules_odd(spark):
    body = prose(300)
    texts = [None, "", "\n \n", "few words", body, body + "\n" + body, "line one here\nline one here\n line one here\n\n\n", " ".join(["a"] * 40), "é ß 漢 $%&\n" * 30, body[:4000].upper(), "x" * 3_000_000 + " " + body, (body + "\r\n") * 400, " ".join(f"w{k}" for k in range(19))]
    rows = [(k if k % 4 else None, t, "1", "2", "3") for k, t in enumerate(texts)] + [(4, body, "1", "2", "3")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ratio string, verdict string, n_words string")
    got = bands.quality_rules(docs).collect()
    assert sorted(str(tuple(r[:7])) for r in got) == sorted(str((i, *brute_rules(t))) for i, t, *_ in rows)
    assert not any(r.kept for r in got if r.base_failed)
    assert bands.quality_rules(docs.limit(0)).count() == 0


def test_quality_rules_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.op13_quality_rules(spark, DATA).collect()
    assert len(got) == len(texts)
    c = zstandard.ZstdCompressor(level=3)
    for r in got:
        assert tuple(r[1:7]) == brute_rules(texts[r.doc_id])
        raw = (texts[r.doc_id] or "").encode()
        assert r.ratio == (len(c.compress(raw)) / len(raw) if raw else None)


def test_bands(spark):
    rng = np.random.default_rng(2)
    noise = " ".join("".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 60)) for _ in range(400))
    clean = prose(6000, 3)
    rows = {1: clean, 2: noise, 3: prose(60, 4), 4: clean[:12000] + noise[:20000], 5: clean + noise[:5000], 6: prose(2000, 5) + " " + " ".join("z" * (20 + k) for k in range(300)), 7: prose(25, 6)[:150]}
    got = {r.doc_id: r.verdict for r in bands.quality_rules(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert got[1] == got[3] == got[5] == "ok"
    assert got[2].startswith("incompressible") and got[4] == "incompressible chunks"
    assert got[6] in ("repetitive", "repetitive chunks")
