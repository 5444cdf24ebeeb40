"""Monthly delimited dumps whose encoding, delimiter and header differ from file to file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C

#: Field and the words that its header cell holds, all of them, without accents. The first unused cell wins, so order counts.
FIELDS = [
    ("client_id", ["IDENTIF", "NATIONAL"]),
    ("periode", ["PERIODE"]),
    ("ressources", ["RESSOURCE"]),
    ("business_line", ["BUSINESS"]),
    ("seg2", ["SEGMENTATION", "NIVEAU"]),
    ("seg_commercial", ["SEGMENTATION", "COMMERCIAL"]),
    ("type_compte", ["TYPE", "COMPTE"]),
    ("rubrique", ["RUBRIQUE"]),
    ("date_ouverture", ["OUVERTURE"]),
    ("ctrvl_kda", ["CTRVL"]),
    ("solde", ["SOLDE"]),
    ("currency", ["DEVISE"]),
]
HEADER = ["IDENTIF", "NATIONAL"]
CELLS = "file string, encoding string, delimiter string, missing array<string>, row_no long, " + ", ".join(f"`{f}` string" for f, _ in FIELDS)


def sniff(data: bytes) -> str:
    """UTF-16 by its mark or by zero bytes near the start, UTF-8 with or without mark, else a Western code page."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    if data[:3] == b"\xef\xbb\xbf":
        return "utf-8-sig"
    if b"\0" in data[:2000]:
        return "utf-16-le"
    for name in ("utf-8", "cp1252"):
        try:
            data.decode(name)
            return name
        except UnicodeDecodeError:
            pass
    return "latin-1"


def plain(cell: str) -> str:
    return cell.translate(str.maketrans(C.ACCENTED, C.PLAIN)).upper().strip()


def resolve(header: list[str], fields: list[tuple[str, list[str]]] = FIELDS) -> dict[str, int]:
    """Field to the first unused cell that holds all its words."""
    cells, used = [plain(c) for c in header], {}
    for name, words in fields:
        at = next((i for i, c in enumerate(cells) if i not in used.values() and all(w in c for w in words)), None)
        if at is not None:
            used[name] = at
    return used


def read_dumps(spark: SparkSession, path: str, fields: list[tuple[str, list[str]]] = FIELDS) -> DataFrame:
    """All rows of a folder's files, each under its own header: file, encoding, delimiter, missing, row_no and the fields as text.

    The header is the first line that holds IDENTIF and NATIONAL; the delimiter the first of tab, semicolon and comma
    in it, else tab. Blank rows, rows without client and files without header give nothing. A file is read by one
    task; a month's files are of bounded size, and there are as many tasks as files.
    """
    names = [f for f, _ in FIELDS]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("encoding", pa.string()), ("delimiter", pa.string()), ("missing", pa.list_(pa.string())), ("row_no", pa.int64()), *[(n, pa.string()) for n in names]])
        for batch in batches:
            for path_, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                encoding = sniff(data or b"")
                lines = (data or b"").decode(encoding, "replace").splitlines()
                top = next((i for i, x in enumerate(lines) if all(w in plain(x) for w in HEADER)), None)
                if top is None:
                    continue
                delimiter = next((d for d in "\t;," if d in lines[top]), "\t")
                place = resolve(lines[top].split(delimiter), fields)
                missing, rows = [n for n, _ in fields if n not in place], []
                for k, line in enumerate(lines[top + 1 :]):
                    cells = [c.strip().strip('"') for c in line.split(delimiter)]
                    values = [cells[place[n]] if place.get(n, len(cells)) < len(cells) else None for n in names]
                    if values[names.index("client_id")]:
                        rows.append((path_, encoding, delimiter, missing, k, *values))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(parse, CELLS)


def records(cells: DataFrame, by_path: bool = False) -> DataFrame:
    """Cells to typed snapshot records; the month is that of the file's name, or of its folders."""
    name = F.element_at(F.split("file", "/"), -1)
    month = C.path_month(F.col("file")) if by_path else C.file_month(name)
    return cells.select(
        "client_id", month.alias("month_int"), "ressources", "business_line", "type_compte", "rubrique", C.opening_month(F.col("date_ouverture")).alias("open_month"),
        C.number(F.col("ctrvl_kda")).alias("ctrvl_kda"), C.number(F.col("solde")).alias("solde"), "currency", C.segment_of(F.coalesce("rubrique", F.lit(""))).alias("segment"),
    ).where("month_int is not null")


def unioned(parts: list[DataFrame]) -> DataFrame:
    """All rows; a column that a part lacks is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by value of each column, in one pass: grouping sets."""
    return rows.groupingSets([[c] for c in columns], *columns).agg(F.count("*").alias("n"), F.grouping_id().alias("of")).select(
        F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]).alias("column"), F.coalesce(*[F.col(c).cast("string") for c in columns]).alias("value"), "n"
    )


def grain(rows: DataFrame, client: str, period: str, label: str) -> DataFrame:
    """Histogram of rows per client and period, with the clients of several labels among them."""
    per = rows.groupBy(client, period).agg(F.count("*").alias("n_rows"), F.countDistinct(label).alias("labels"))
    return per.groupBy("n_rows").agg(F.count("*").alias("n"), F.sum((F.col("labels") > 1).cast("int")).alias("several_labels"))


def balance_quality(rows: DataFrame, value: str) -> DataFrame:
    """Missing, zero, negative and valid values, and their quantiles by linear interpolation."""
    v, count = F.col(value), lambda c: F.sum(F.when(c, 1).otherwise(0))
    q = rows.agg(count(v.isNull()).alias("missing"), count(v == 0).alias("zero"), count(v < 0).alias("negative"), F.count(v).alias("valid"), F.percentile(v, F.array(*map(F.lit, (0.0, 0.25, 0.5, 0.75, 0.95, 1.0)))).alias("q"))
    return q.select("missing", "zero", "negative", "valid", *[F.get("q", F.lit(k)).alias(f"q{p}") for k, p in enumerate((0, 25, 50, 75, 95, 100))])


def write_panel(panel: DataFrame, path: str) -> None:
    """Partitioned by segment and year, so scans of one book or some years read only those."""
    panel.write.mode("overwrite").partitionBy("segment", "year").parquet(path)


def append_scores(scores: DataFrame, path: str) -> int:
    """Append scores (asof_month, version, ...) that aren't in the table yet; returns the number of new runs."""
    spark = scores.sparkSession
    try:
        done = spark.read.parquet(path).select("asof_month", "version").distinct()
        scores = scores.join(done, ["asof_month", "version"], "left_anti")
    except Exception as e:  # the first run
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    scores = scores.persist()
    n = scores.select("asof_month", "version").distinct().count()
    if n:
        scores.write.mode("append").parquet(path)
    scores.unpersist()
    return n


def opening_dates(rows: DataFrame, cell: str) -> DataFrame:
    """How many cells are dates, how many hold something else, and the dates' first and last year."""
    month, text = C.opening_month(F.col(cell)), F.trim(F.col(cell))
    return rows.agg(
        F.count(month).alias("parsed"), F.count(F.when(month.isNull() & (F.length(text) > 0), 1)).alias("unparsed"),
        F.min(F.floor(month / 12)).cast("int").alias("first_year"), F.max(F.floor(month / 12)).cast("int").alias("last_year"),
    )


def typed_panel(rows: DataFrame, features: list[str], passthrough: list[str]) -> DataFrame:
    """A panel's text cells typed: month_int, event, features and weight; a blank weight is 1. Rows that lack another are dropped."""
    cell = lambda c, kind: F.when(F.length(F.trim(c)) > 0, F.trim(c)).try_cast(kind)
    typed = rows.select(
        *passthrough, cell(F.col("month_int"), "int").alias("month_int"), cell(F.col("event"), "int").alias("event"),
        *[cell(F.col(f), "double").alias(f) for f in features], F.coalesce(cell(F.col("weight"), "double"), F.lit(1.0)).alias("weight"),
    )
    return typed.na.drop(subset=["month_int", "event", *features])


def tidy_series(rows: DataFrame) -> DataFrame:
    """Text rows (series, ref_period as YYYY-MM, value, available_date) as month_int, value and the day they can be known; blanks go."""
    value = F.trim(F.col("value")).try_cast("double")
    part = lambda k: F.get(F.split(F.trim(F.col("ref_period")), "-"), F.lit(k)).try_cast("int")
    typed = rows.select("series", C.month_int(part(0), part(1)).alias("month_int"), value.alias("value"), F.trim(F.col("available_date")).try_cast("date").alias("available"))
    return typed.where("value is not null and month_int is not null")


def write_months(rows: DataFrame, path: str) -> None:
    """A folder of CSV files for each month of rows (month_int)."""
    month = F.col("month_int")
    named = rows.withColumns({"year": F.floor(month / 12).cast("int"), "month": (month % 12 + 1).cast("int")})
    named.repartition("year", "month").write.mode("overwrite").partitionBy("year", "month").option("header", True).csv(path)


def write_series(rows: DataFrame, path: str) -> None:
    """Macro series (series, month_int, value, ...) by series."""
    rows.write.mode("overwrite").partitionBy("series").parquet(path)


def write_calibration(table: DataFrame, path: str) -> None:
    """A reliability table as one CSV of bin, n, predicted, actual and weighted actual: some bins a group."""
    named = table.select(*[c for c in table.columns if c not in ("mean_p", "mean_y", "w_mean_p", "w_mean_y")], F.col("mean_p").alias("predicted"), F.col("mean_y").alias("actual"), F.col("w_mean_y").alias("weighted_actual"))
    named.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
