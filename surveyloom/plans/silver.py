"""Raw editions to the silver table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import named
from ..functions.names import POSITION, Step, steps_for
from ..operators.clean import (
    binary_columns_of, bool_to_flag, dedup_by_key, dedup_rare_repeats, fill_answers, repeated_hashes,
)
from ..operators.harmonise import clean_columns, harmonise, select_curated
from ..operators.profile import shapes_by
from ..operators.unify import tag_year, unify
from ..session import delete_folder, scratch_folders, scratch_path
from ..sources.files import read_csv, write_parquet

MappingRow = tuple[str, int, str, str]


def read_mapping(spark: SparkSession, path: str, editions: Sequence[str] = ()) -> list[MappingRow]:
    """Distinct mapping rows ``edition,step,source,target`` from a CSV file, of the given editions if any are named.

    These are names of columns and become driver metadata, as the columns themselves are.
    """
    table = read_csv(spark, path).select("edition", "step", "source", "target")
    if editions:
        table = table.where(F.col("edition").cast("string").isin(*[str(e) for e in editions]))
    rows = table.distinct().collect()
    return [(str(r.edition), int(r.step), r.source, r.target) for r in rows]


def prepare_edition(
    raw: DataFrame, steps: Sequence[Step] = (), curated: Sequence[str] = (), keep: str = "last"
) -> DataFrame:
    """One raw edition under common names, curated, booleans as 0/1. One projection, no shuffle.

    A column of file positions, as ``read_csv`` and ``read_parquet`` add it on request, stays.
    """
    df = harmonise(clean_columns(raw), steps, keep)
    if curated:
        place = [POSITION] if POSITION in df.columns else []
        df = df.select(*select_curated(df.drop(POSITION), curated).columns, *place)
    return bool_to_flag(df)


def finish_edition(
    df: DataFrame,
    year: int,
    flags: Sequence[str],
    key: str = "id",
    order: Sequence[Column | str] = (),
    repeated: DataFrame | None = None,
) -> DataFrame:
    """A prepared edition filled, one row per respondent, tagged with its year.

    Of the rows of a respondent the first by ``order`` stays; without one the first in the files where the edition
    carries positions, or else the first by all other columns. With the hashes of repeated keys, only the rows of
    those keys are shuffled.
    """
    ticks = [c for c in flags if c in df.columns and c not in (key, POSITION)]
    filled = fill_answers(df, ticks, keep=[key])
    others = [POSITION] if POSITION in df.columns else [c for c in df.columns if c != key]
    by = list(order) or [named(c) for c in others]
    if repeated is None:
        single = dedup_by_key(filled, key, by)
    else:
        single = dedup_rare_repeats(filled, key, by, repeated.where(F.col("edition") == year))
    return tag_year(single.drop(POSITION), year)


def write_editions(editions: Mapping[int, DataFrame], path: str) -> dict[int, DataFrame]:
    """Write each edition with all its own columns to a folder per year, and read them back.

    The editions are independent jobs and are submitted together, so that one edition's last
    tasks do not leave the cluster idle.
    """

    def write(year: int) -> DataFrame:
        folder = f"{path.rstrip('/')}/ano_{year}"
        write_parquet(editions[year], folder)
        return editions[year].sparkSession.read.schema(editions[year].schema).parquet(folder)

    with ThreadPoolExecutor(len(editions)) as pool:
        return dict(zip(editions, pool.map(write, editions)))


def build_editions(
    raw: Mapping[int, DataFrame],
    mapping: Iterable[MappingRow] = (),
    curated: Sequence[str] = (),
    flags: Sequence[str] = (),
    detect: bool = True,
    stage: bool = True,
    key: str = "id",
    order: Sequence[Column | str] = (),
) -> dict[int, DataFrame]:
    """Every raw edition harmonised, curated, filled, deduplicated and tagged.

    Flags are the declared ones and, with ``detect``, the columns of an edition whose every
    answer in the file is 0 or 1, found by one job for all editions. With ``stage`` the prepared
    editions are written to the shared scratch folder first: the raw files are then parsed once,
    detection and the search for repeated respondents read single columns of Parquet, and only the
    rows of repeated respondents are shuffled. ``write_silver`` deletes what was staged.
    """
    rows = list(mapping)
    prepared = {year: prepare_edition(df, steps_for(rows, str(year)), curated) for year, df in raw.items()}
    if stage:
        prepared = write_editions(prepared, scratch_path(next(iter(raw.values())).sparkSession, "staged"))
    found = binary_columns_of(prepared) if detect else {}
    repeated = repeated_hashes(prepared, [key]) if stage else None
    return {
        year: finish_edition(df, year, list(dict.fromkeys([*flags, *found.get(year, [])])), key, order, repeated)
        for year, df in prepared.items()
    }


def build_silver(raw: Mapping[int, DataFrame], *, as_string: bool = False, **options) -> DataFrame:
    """All editions, unified on the columns they share; options as for ``build_editions``."""
    return unify(build_editions(raw, **options), "common", as_string)


def write_silver(
    silver: DataFrame, path: str, year: str = "ano", replace: str = "years", drop_staged: bool = True
) -> DataFrame:
    """Write the table split by year and read it back, so that later steps start from files.

    ``replace`` says what goes: the ``years`` the frame has rows of, or the whole ``table``. Editions that were
    staged for the frame are deleted after the write, unless ``drop_staged`` is false; the frame itself can't be
    read any more then.
    """
    if replace not in ("years", "table"):
        raise ValueError("replace is 'years' or 'table'")
    staged = scratch_folders(silver, ("staged", "repeats")) if drop_staged else []
    write_parquet(silver, path, year, whole=replace == "table")
    for folder in staged:
        delete_folder(silver.sparkSession, folder)
    return silver.sparkSession.read.schema(silver.schema).parquet(path).select(*[named(c) for c in silver.columns])


def proof_counts(silver: DataFrame, year: str = "ano", widths: Mapping[int, int] | None = None) -> DataFrame:
    """Rows and columns per edition, from one count over the written table.

    ``widths`` gives the number of columns that each edition itself has; without it, all have the table's.
    """
    counted = shapes_by(silver, year)
    if widths is not None:
        own = F.lit(None).cast("bigint")
        for when, width in widths.items():
            own = F.when(F.col(year).cast("string") == str(when), F.lit(width).cast("bigint")).otherwise(own)
        counted = counted.withColumn("n_columns", own)
    return counted.orderBy(F.asc(year))
