"""Text clean-up and names derived from file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import col

# File types, file-name patterns and month abbreviations.
STAFFING = "PBJ_STAFFING"
SNAPSHOT = "NH_PROVIDER_INFO"
STAFFING_NAME = r"(?i)^PBJ_Daily_Nurse_Staffing_.*\.csv$"
SNAPSHOT_NAME = r"(?i)^NH_ProviderInfo_([A-Za-z]{3})(\d{4})(?: \(\d+\))?\.csv$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

UNDECODABLE = "�"


def blank_to_null(c: Column | str) -> Column:
    """Empty or all-blank text becomes NULL, anything else is unchanged."""
    return F.when(F.trim(col(c)) != "", col(c))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """``blank_to_null`` on every string column, in one projection."""
    return df.select(
        [
            blank_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def replace_undecodable(c: Column | str) -> Column:
    """Bytes the UTF-8 reader could not decode become ``?``."""
    return F.replace(col(c), F.lit(UNDECODABLE), F.lit("?"))


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def file_type(name: Column | str) -> Column:
    """Feed a file belongs to; NULL when the name follows no convention.

    A snapshot name with an unknown month keeps its type and has no period,
    so it is refused rather than filed under a guess.
    """
    n = col(name)
    return F.when(n.rlike(SNAPSHOT_NAME), F.lit(SNAPSHOT)).when(n.rlike(STAFFING_NAME), F.lit(STAFFING))


def snapshot_period(name: Column | str) -> Column:
    """``NH_ProviderInfo_Oct2024.csv`` -> 20241001, NULL for other names."""
    n = col(name)
    month = F.array_position(
        F.array([F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(n, SNAPSHOT_NAME, 1))
    )
    year = F.regexp_extract(n, SNAPSHOT_NAME, 2).try_cast("int")
    return F.when(month > 0, (year * 10000 + month * 100 + 1).cast("int"))


def name_error(name: Column | str) -> Column:
    """Why a file name is refused; NULL when it is accepted."""
    n = col(name)
    return (
        F.when(file_type(n).isNull(), F.concat(F.lit("no feed uses this file name: "), n))
        .when(
            (file_type(n) == SNAPSHOT) & snapshot_period(n).isNull(),
            F.concat(F.lit("the file name holds no month: "), n),
        )
    )


def wall_clock(stamp: Column | str) -> Column:
    """ISO-8601 text -> ``yyyyMMdd_HHmmss`` in the stamp's own offset.

    Goes through TIMESTAMP_NTZ so the session time zone never shifts it; NULL
    when the text is no timestamp.
    """
    bare = F.regexp_replace(col(stamp), r"(Z|[+-]\d{2}:?\d{2})$", "")
    text = F.substr(bare.try_cast("timestamp_ntz").cast("string"), F.lit(1), F.lit(19))
    return F.concat(
        F.translate(F.substr(text, F.lit(1), F.lit(10)), "-", ""),
        F.lit("_"),
        F.translate(F.substr(text, F.lit(12), F.lit(8)), ":", ""),
    )


def landing_name(name: Column | str, stamp: Column | str) -> Column:
    """Versioned name a file is kept under: ``<stem>_<yyyyMMdd_HHmmss>.csv``."""
    stem = F.regexp_replace(F.regexp_replace(col(name), r"\.csv$", ""), r"\.CSV$", "")
    return F.concat(stem, F.lit("_"), wall_clock(stamp), F.lit(".csv"))


def table_name(path: Column | str) -> Column:
    """SQL-safe upper-case table name for a file path.

    The runs of ASCII letters and digits of the file's stem, joined by single
    underscores; a name must not begin with a digit.
    """
    stem = F.regexp_extract(file_name(path), r"(?is)^(.*?)(\.csv(\.gz)?)?$", 1)
    name = F.upper(F.array_join(F.regexp_extract_all(stem, F.lit("[0-9A-Za-z]+"), 0), "_"))
    return F.concat(F.when(F.ascii(name).between(48, 57), F.lit("T_")).otherwise(F.lit("")), name)
