"""Declarative registry: datasets, dimensions, measures, levels, and the contract of the source grid."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

CELL = ["grid_lon", "grid_lat"]
MEASURES = ("n_noise", "n_noise_postprocessed")
DEFAULT_MEASURE, RAW_ABOVE = "n_noise_postprocessed", 600_000
#: Id prefixes of the territories, which the grid does not cover.
TERRITORIES = ("60", "66", "69", "72", "78")

#: Fixed values: (dimension, code, label, residual) in declared order.
DIMENSION_VALUES = (
    ("race_ethnicity", "White", "White", False),
    ("race_ethnicity", "Black", "Black", False),
    ("race_ethnicity", "Hispanic", "Hispanic", False),
    ("race_ethnicity", "Asian", "Asian", False),
    ("race_ethnicity", "AIAN", "American Indian & Alaska Native (AIAN)", False),
    ("race_ethnicity", "Other/Unknown", "Other or unknown", True),
    ("age_group", "Under 18", "Under 18", False),
    ("age_group", "19-65", "18–64", False),
    ("age_group", "Over 65", "65 and over", False),
    ("age_group", "Missing Age", "Age not reported", True),
    ("sex", "M", "Male", False),
    ("sex", "F", "Female", False),
    ("sex", "Missing Gender", "Not reported", True),
    ("income_decile", "0", "Decile 0", True),
    ("income_decile", "1", "1st (lowest)", False),
    ("income_decile", "2", "2nd", False),
    ("income_decile", "3", "3rd", False),
    ("income_decile", "4", "4th", False),
    ("income_decile", "5", "5th", False),
    ("income_decile", "6", "6th", False),
    ("income_decile", "7", "7th", False),
    ("income_decile", "8", "8th", False),
    ("income_decile", "9", "9th", False),
    ("income_decile", "10", "10th (highest)", False),
)


@dataclass(frozen=True)
class Dataset:
    name: str
    dims: tuple[str, ...]
    first: int
    last: int
    preliminary: tuple[int, ...] = ()
    excluded: dict[int, str] = field(default_factory=dict)
    not_joinable_with: tuple[str, ...] = ()
    label: str = ""


@dataclass(frozen=True)
class Level:
    name: str
    rank: int
    complete: bool = True
    mapped: bool = True
    disabled: str | None = None


_FEW = "too few people were counted in this year to be compared with others"
DATASETS = {
    "ageracesex": Dataset("ageracesex", ("race_ethnicity", "age_group", "sex"), 2000, 2024, (2025,), {1999: _FEW}, ("raceincome",), "Population by age, race, and sex"),
    "raceincome": Dataset("raceincome", ("race_ethnicity", "income_decile"), 2000, 2024, (2025,), {1999: _FEW}, ("ageracesex",), "Population by race and income decile"),
}
LEVELS = {
    x.name: x
    for x in (
        Level("nation", 0), Level("state", 1), Level("county", 2), Level("czone2020", 3), Level("puma", 4), Level("cbsa", 4, complete=False), Level("zcta", 5, complete=False, mapped=False),
        Level("tract", 6, mapped=False, disabled="units hold so few people that noise outweighs the counts"), Level("cd", 6, disabled="boundaries change between the years"),
    )
}


def source_schema(dims: tuple[str, ...]) -> T.StructType:
    """The contract of a source file: string cell keys and codes (deciles ship as doubles), two double measures."""
    kind = {"income_decile": T.DoubleType()}
    fields = [T.StructField(c, T.StringType()) for c in CELL] + [T.StructField(d, kind.get(d, T.StringType())) for d in dims]
    return T.StructType(fields + [T.StructField(m, T.DoubleType()) for m in MEASURES])


def dataset(name: str) -> Dataset:
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name}")
    return DATASETS[name]


def check_facets(name: str, facets: dict[str, list]) -> None:
    """Datasets can't be joined on their dimensions: a facet that another dataset has and this one lacks is an error."""
    own = dataset(name)
    for dim in facets:
        if dim not in own.dims:
            others = [d for d in own.not_joinable_with if dim in DATASETS[d].dims]
            raise ValueError(f"{name} has no {dim}" + f"; {', '.join(others)} has it, but can't be joined with it" * bool(others))


def level(name: str) -> Level:
    found = LEVELS.get(name)
    if found is None:
        raise ValueError(f"unknown level {name}")
    if found.disabled:
        raise ValueError(found.disabled)
    return found


def dimension_values(spark: SparkSession) -> DataFrame:
    """(dim, ord, code, label, residual): declared order starts at 0 in each dimension."""
    seen: dict[str, int] = {}
    rows = []
    for dim, code, label, residual in DIMENSION_VALUES:
        rows.append((dim, seen.setdefault(dim, 0), code, label, residual))
        seen[dim] += 1
    return spark.createDataFrame(rows, "dim string, ord int, code string, label string, residual boolean")
