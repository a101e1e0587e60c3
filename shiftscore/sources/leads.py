"""Lead-sheet readers.

Sheets arrive as CSV exports (or Parquet), one file or a folder of them.  CSV is
read by RFC 4180: quoted cells may hold commas, doubled quotes and line breaks,
so a file is one task; a sheet too large for that belongs into Parquet.

Each file has its own header: files with the same header are read together, by
it, and these groups are united by name, so sheets whose columns stand in
another order, or that have more columns, are one list.  Every column is a
string by an explicit schema, nothing is inferred; headers are matched by their
letters and digits, so ``House Shifting Date``, ``House.Shifting.Date`` and
``house_shifting_date`` are one; a column that the job needs and a sheet lacks
is an error that names the sheet.  Cells are converted with ``try_cast``, so a
bad cell becomes NULL (ANSI mode is on).

Rows with too many or too few cells stay in the list, as far as their cells go
(or are left out, if asked for), and are given apart, with their file and raw
record, for the quarantine table of the job.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Sheet header -> column name used here (open-opportunity sheet).
OPEN_LEAD_HEADERS = {
    "Mobile": "mobile",
    "Source": "source",
    "Pickup Address": "pickup_address",
    "Drop Address": "drop_address",
    "House Shifting Date": "shifting_date",
    "House Shifting Opportunity: Created Date": "created_date",
    "Count of order interests": "order_interests",
}

# Call sheet: 16 columns, by position c c T c n c c D c c c c c c c c (c text,
# T timestamp, n number, D date).  The job reads eight of them, by name and with
# the type of their position, so the order of a sheet doesn't matter:
CALL_LEAD_HEADERS = {
    "Timestamp": "lead_ts",
    "Mobile Number": "mobile",
    "Source": "source",
    "Pickup address": "pickup_address",
    "Drop_address": "drop_address",
    "Tentative Shifting Date": "shifting_date",
    "Calling Timestamp": "calling_status",
    "WA_Tentative Shifting Date": "wa_shifting_date",
}

OPEN_LEAD_TYPES = {
    "mobile": "phone",
    "source": "string",
    "pickup_address": "string",
    "drop_address": "string",
    "shifting_date": "date",
    "created_date": "date",
    "order_interests": "int",
}
CALL_LEAD_TYPES = {
    "mobile": "phone",
    "source": "string",
    "pickup_address": "string",
    "drop_address": "string",
    "lead_ts": "timestamp",
    "shifting_date": "date",
    "calling_status": "string",
    "wa_shifting_date": "string",
}


def snake_case(name: str) -> str:
    """'House Shifting Opportunity: Created Date' -> 'house_shifting_opportunity_created_date'."""
    s = re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()
    return s or "col"


def header_key(name: str) -> str:
    """What two forms of one header have in common: letters and digits."""
    return re.sub(r"[^0-9a-z]+", "", name.lower())


def normalize_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename sheet headers (O03): mapped names by their letters and digits, the rest to snake_case."""
    known = {header_key(k): v for k, v in (mapping or {}).items()}
    known |= {header_key(v): v for v in (mapping or {}).values() if header_key(v) not in known}
    names, seen = [], set()
    for c in df.columns:
        base = n = known.get(header_key(c)) or snake_case(c)
        i = 1
        while n in seen:
            i += 1
            n = f"{base}_{i}"
        seen.add(n)
        names.append(n)
    return df.toDF(*names)


def _phone(col) -> F.Column:
    # Sheets hold phone numbers as numbers, sometimes rendered as 9.9e+09.
    s = F.trim(col.cast("string"))
    return F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))


def apply_types(df: DataFrame, types: dict[str, str], sheet: str = "the sheet") -> DataFrame:
    """Keep the typed columns of a normalised sheet, converting text with try_cast."""
    missing = [name for name in types if name not in df.columns]
    if missing:
        raise ValueError(f"{sheet} has no column for {', '.join(missing)}; it has {', '.join(df.columns)}")
    out, have = [], dict(df.dtypes)
    for name, t in types.items():
        c = F.col(name)
        if t == "phone":
            c = _phone(c)
        elif t == "timestamp":
            c = c.try_cast("timestamp_ntz") if have[name] == "string" else c
        elif have[name] != t:
            c = F.col(name).cast("string").try_cast(t) if t != "string" else c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)


CSV_OPTIONS = {"header": True, "mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": True}
#: Column of the raw record of a row with a wrong number of cells, and of its file.
MALFORMED, FILE = "_malformed", "_file"
#: Headers that are read at a time.
HEADER_READERS = 8


@dataclass
class LeadSheets:
    """A lead list and the rows that don't have as many cells as their sheet's header: ``file, record``."""

    leads: DataFrame
    malformed: DataFrame


def header_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a CSV sheet or folder by their header; only the first record of each file is read."""
    files = sorted(spark.read.format("text").load(path).inputFiles())
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda f: tuple(spark.read.options(**CSV_OPTIONS).csv(f).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(headers, files):
        if header:  # an empty file has no header and no row
            groups.setdefault(header, []).append(file)
    return groups


def _csv_group(spark: SparkSession, header: tuple[str, ...], files: list[str], null_value: str) -> DataFrame:
    """Rows of files with one header, as text, with the raw record of malformed ones and their file."""
    # A field equal to ``null_value`` (blank by default, as a sheet's empty
    # cell) is NULL, a quoted empty field is "".  Whether a row has the right
    # number of cells shows only if all are looked at.
    schema = StructType([*[StructField(n, StringType()) for n in header], StructField(MALFORMED, StringType())])
    reader = spark.read.options(**CSV_OPTIONS).options(nullValue=null_value, columnNameOfCorruptRecord=MALFORMED, columnPruning=False)
    rows = reader.schema(schema).csv(files)
    return rows.select("*", F.col("_metadata.file_path").alias(FILE))


def _looked_at(header: tuple[str, ...]):
    """True; but Spark doesn't answer from the column of raw records alone, so all cells are looked at."""
    return F.length(F.concat_ws("", *[F.col("`" + c.replace("`", "``") + "`") for c in header])) >= 0


def _malformed(rows: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """``file, record`` of malformed rows."""
    return rows.where(F.col(MALFORMED).isNotNull() & _looked_at(header)).select(F.col(FILE).alias("file"), F.col(MALFORMED).alias("record"))


def read_sheets(spark: SparkSession, path: str, headers: dict[str, str], types: dict[str, str],
                fmt: str = "csv", null_value: str = "", set_aside: bool = False) -> LeadSheets:
    """All sheets under ``path`` as one typed list.  ``set_aside`` leaves malformed rows out of it."""
    if fmt != "csv":
        none = spark.createDataFrame([], "file string, record string")
        return LeadSheets(apply_types(normalize_columns(spark.read.format(fmt).load(path), headers), types), none)
    leads, malformed = [], []
    for header, files in header_groups(spark, path).items():
        rows = _csv_group(spark, header, files, null_value)
        said = files[0] if len(files) == 1 else f"{files[0]} and {len(files) - 1} more"
        kept = rows.where(F.col(MALFORMED).isNull() & _looked_at(header)) if set_aside else rows
        leads.append(apply_types(normalize_columns(kept.drop(MALFORMED, FILE), headers), types, said))
        malformed.append(_malformed(rows, header))
    if not leads:
        raise ValueError(f"there is no sheet with a header under {path}")
    return LeadSheets(reduce(DataFrame.unionByName, leads), reduce(DataFrame.unionByName, malformed))


def read_open_sheets(spark: SparkSession, path: str, fmt: str = "csv", null_value: str = "", set_aside: bool = False) -> LeadSheets:
    """Open-opportunity leads (O01): all rows, no status filter."""
    return read_sheets(spark, path, OPEN_LEAD_HEADERS, OPEN_LEAD_TYPES, fmt, null_value, set_aside)


def read_call_sheets(spark: SparkSession, path: str, fmt: str = "csv", null_value: str = "", set_aside: bool = False) -> LeadSheets:
    """Call-sheet leads (O02), each column with its type of the 16-column sheet, wherever it stands."""
    return read_sheets(spark, path, CALL_LEAD_HEADERS, CALL_LEAD_TYPES, fmt, null_value, set_aside)


def read_open_leads(spark: SparkSession, path: str, fmt: str = "csv", null_value: str = "") -> DataFrame:
    """The list of :func:`read_open_sheets`."""
    return read_open_sheets(spark, path, fmt, null_value).leads


def read_call_leads(spark: SparkSession, path: str, fmt: str = "csv", null_value: str = "") -> DataFrame:
    """The list of :func:`read_call_sheets`."""
    return read_call_sheets(spark, path, fmt, null_value).leads


def malformed_rows(spark: SparkSession, path: str, null_value: str = "") -> int:
    """Rows of a CSV sheet whose number of cells isn't that of their file's header."""
    return sum(_malformed(_csv_group(spark, h, f, null_value), h).count() for h, f in header_groups(spark, path).items())


def sheet_frame(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Inverse of the normalisation: name columns as the sheet does (for export)."""
    inverse = {v: k for k, v in headers.items()}
    return df.select(*[F.col(c).alias(inverse.get(c, c)) for c in df.columns])
