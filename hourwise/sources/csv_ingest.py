"""Raw CSV ingest (S1-S6): canonical headers, file-order row numbers,
typing + domain validation with row numbers, quarantine, completeness gate.

The CSV reader would silently drop blank lines and rename duplicate headers,
both fatal for this contract, so files are read as text lines:

* every line gets its 0-based position in its file: lines are counted per
  split (``_metadata.file_path`` / ``file_block_start``), split offsets are a
  prefix sum over a table with one row per split, and the position inside a
  split comes from ``monotonically_increasing_id``; the offsets are looked up by
  a size-checked broadcast, so the text is not shuffled;
* a quoted cell may hold line breaks. Files in which some line has an odd number of quotes have their lines put
  together to records: the number of odd lines before a line, by split and inside its split, tells whether it begins a
  record. Only these files are shuffled, by split, and only the lines of longer records are grouped;
* record 0 of each file is its header, mapped to canonical names where the headers are, in a table of one row for each
  different header;
* data records are split, typed with regex guards before ``try_cast`` (the casts
  alone accept ``'1d'``, hex floats and zone offsets), and every failed check
  becomes a violation code.  ``source_row`` numbers data records 1..N in file
  order across files sorted by path.

Every record is typed and checked once, in one job that writes a table; valid rows and quarantine read it.
"""

from __future__ import annotations

import csv
from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourwise.session import discard, materialize
from hourwise.spec import READING_SCHEMA, ReadingSchema

# naive ISO-8601 date or date-time (no zone designator)
ISO_NAIVE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"
ZONE_SUFFIX = r"(Z|[+-]\d{2}(:?\d{2})?)$"
DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
NON_FINITE = r"^\s*[+-]?(inf|infinity|nan)\s*$"


class IngestError(ValueError):
    pass


#: Splits up to which their table (about 200 bytes each) is broadcast; more are joined by a shuffle.
BROADCAST_SPLITS = 100_000
#: A control character that readings cannot hold.
CELL_END = "\x1f"
#: Lines of a record; a longer one counts as an open quote, and only its first line is kept.
MAX_RECORD_LINES = 1_000


def _ship_by_value() -> None:
    """Headers are mapped on the executors, which need no installed copy of the package."""
    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()


def _squeezed(name: str) -> str:
    return "".join(c for c in name.lower() if c.isascii() and c.isalnum())


def field_order(header: str, schema: ReadingSchema = READING_SCHEMA) -> list[int]:
    """The position in a header line of every canonical field. A field that no column or more than one
    column stands for is fatal."""
    known = {_squeezed(f): f for f in schema.fields} | dict(schema.aliases)
    names = [known.get(_squeezed(cell)) for cell in next(csv.reader([header.lstrip("\ufeff")]), [])]
    counts = Counter(n for n in names if n)
    if twice := sorted(n for n, k in counts.items() if k > 1):
        raise IngestError(f"Duplicate CSV column: {', '.join(twice)} (header {header!r})")
    if absent := [f for f in schema.fields if f not in counts]:
        raise IngestError(f"CSV is missing required columns {absent} (header {header!r})")
    return [names.index(f) for f in schema.fields]


def _text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_mid"))


@contextmanager
def fixed_splits(spark: SparkSession):
    """Row ids must not change between two scans with the number of cores; the session's own setting comes back afterwards."""
    key = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(key, None)
    if old is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)


def _odd(line) -> Column:
    """Whether a line has an odd number of quotes."""
    c = F.col(line) if isinstance(line, str) else line
    return F.when(c.contains('"'), (F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))) % 2 == 1).otherwise(F.lit(False))


def split_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per split: file, block, lines before it, first row id, data rows of earlier files, first line of its
    file, lines with an odd number of quotes before it and in its file. Written once; the only table of a load that needs an order.
    It and what reads lines by it belong into ``fixed_splits``."""
    splits = materialize(_text(spark, path).groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"), F.min_by("value", "_mid").alias("_line0"),
        F.count_if(_odd("value")).alias("_odd")), "csv_splits")
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg((F.sum("_n") - 1).alias("_data"), F.min_by("_line0", "block").alias("header"),
                                       F.sum("_odd").alias("_odd_lines"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", "header", "_odd_lines", "_data", F.coalesce(F.sum("_data").over(earlier), F.lit(0)).alias("_foff"))
    before = lambda c: F.coalesce(F.sum(c).over(in_file), F.lit(0))
    out = materialize(splits.select("file", "block", "_mid0", before("_n").alias("_off"), before("_odd").alias("_odd_before"))
                      .join(files, "file"), "csv_offsets")
    discard(splits)
    return out


def _looked_up(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with the columns of their split."""
    small = splits.count() <= BROADCAST_SPLITS
    return lines.join(F.broadcast(splits) if small else splits, ["file", "block"])


def numbered_lines(spark: SparkSession, path: str | list[str], splits: DataFrame) -> DataFrame:
    """S3: ``(file, line_no, _foff, header, value)`` with 0-based line positions in file order.

    A line's position in its split comes from ``monotonically_increasing_id`` (rows of one split are
    contiguous); the split's offset is looked up, so the text itself is not moved.
    """
    return _looked_up(_text(spark, path), splits).select(
        "file", (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias("line_no"), "_foff", "header", "value")


def joined_records(spark: SparkSession, path: str | list[str], splits: DataFrame) -> DataFrame:
    """``(file, rec_no, value, closed)`` of the records of the files that have lines with an odd number of quotes."""
    own = splits.filter("_odd_lines > 0").select("file", "block", "_mid0", "_off", "_odd_before")
    lines = _looked_up(_text(spark, path), own).withColumn("_is_odd", _odd("value"))
    down = Window.partitionBy("file", "block").orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("_odd_before") + F.count_if("_is_odd").over(down) - F.col("_is_odd").cast("long")
    lines = lines.withColumns({"line_no": F.col("_off") + F.col("_mid") - F.col("_mid0"), "_begins": before % 2 == 0})
    lines = materialize(lines.select("file", "block", "line_no", "value", "_is_odd", "_begins",
                                     F.count_if("_begins").over(down).alias("_seq")), "csv_odd_lines")
    # a line belongs to the last record begun at or before it, maybe in an earlier split
    begun = lines.groupBy("file", "block").agg(F.count_if("_begins").alias("_n"))
    carry = begun.select("file", "block", F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_records"))
    lines = lines.join(carry, ["file", "block"]).withColumn("rec_no", F.col("_records") + F.col("_seq") - 1)
    whole = lines.filter("_begins AND NOT _is_odd").select("file", "rec_no", "value", F.lit(True).alias("closed"))
    part = lines.filter("NOT _begins OR _is_odd").select("file", "rec_no", "line_no", "value", "_is_odd")
    head = part.groupBy("file", "rec_no").agg(F.min("line_no").alias("_head"))
    part = part.join(head, ["file", "rec_no"])
    near = F.col("line_no") < F.col("_head") + MAX_RECORD_LINES
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(near, F.struct("line_no", "value")))), lambda x: x["value"]), "\n")
    put = part.groupBy("file", "rec_no").agg(text.alias("_text"), F.min_by("value", "line_no").alias("_line"),
                                             F.count(F.lit(1)).alias("_n"), F.count_if("_is_odd").alias("_odd"))
    closed = (F.col("_odd") % 2 == 0) & (F.col("_n") <= MAX_RECORD_LINES)
    return whole.unionByName(put.select("file", "rec_no", F.when(closed, F.col("_text")).otherwise(F.col("_line")).alias("value"),
                                        closed.alias("closed")))


def header_table(headers: DataFrame, schema: ReadingSchema = READING_SCHEMA) -> DataFrame:
    """``(header, _at, _error)``: the position of every canonical field, or why there is none, for each different header."""
    def mapped(batches):
        for pdf in batches:
            at, errors = [], []
            for h in pdf["header"]:
                try:
                    at.append(field_order(h, schema))
                    errors.append(None)
                except IngestError as e:
                    at.append(None)
                    errors.append(str(e))
            yield pdf.assign(_at=at, _error=errors)
    return headers.select("header").distinct().mapInPandas(mapped, "header string, _at array<int>, _error string")


def fields_of(line: Column) -> Column:
    """The cells of a CSV line: quoted cells may hold commas and doubled quotes.

    Between quotes, every second piece is inside a cell; an empty piece between two others is a doubled quote. Commas
    outside become ``CELL_END``, at which the line is split.
    """
    pieces = F.split(line, '"')

    def piece(p, i):
        return F.when(i % 2 == 1, p).when((p == "") & (i > 0) & (i < F.size(pieces) - 1), F.lit('"')).otherwise(
            F.replace(p, F.lit(","), F.lit(CELL_END)))
    quoted = F.split(F.array_join(F.transform(pieces, piece), ""), CELL_END)
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def _number(c: Column) -> Column:
    """Decimal text -> double (infinite if it is too large); anything else (incl. '1d', hex, inf, NaN) -> NULL."""
    return F.when(c.rlike(DECIMAL), F.trim(c).try_cast("double"))


def typed_with_violations(records: DataFrame, schema: ReadingSchema = READING_SCHEMA) -> DataFrame:
    """Typed canonical columns + ``violations array<string>`` (empty = valid), with the record's text if it is not valid.

    ``records`` holds (source_row, line, closed, _cells, _at). Violation codes, in check order: blank_row, open_quote or
    short_row (reported alone), bad_timestamp / timezone, missing_field / non_finite / unparseable per number,
    not_0_1 per digital, invalid_impulse.

    The numbers are one array, typed by one expression, and codes are only made for records that fail: sixteen separate
    checks would make a method too large for the JVM to compile.
    """
    n_analog, n_digital = len(schema.analog), len(schema.digital)
    numeric = [*schema.analog, *schema.digital, schema.impulse]
    canonical = records.select("source_row", "line", "closed", (F.size("_cells") <= F.array_max("_at")).alias("_short"),
                               F.transform("_at", lambda i: F.get("_cells", i)).alias("_c"))
    ts_raw = F.trim(F.get("_c", F.lit(0)))
    typed = canonical.select(
        "source_row", "line", "closed", "_short", "_c", F.when(ts_raw.rlike(ISO_NAIVE), ts_raw.try_cast("timestamp_ntz")).alias("_ts"),
        F.transform(F.slice("_c", 2, len(numeric)), _number).alias("_n"))
    digital = F.slice("_n", n_analog + 1, n_digital)
    fine = (F.col("closed") & ~F.col("_short") & F.col("_ts").isNotNull() & F.forall("_n", lambda v: F.abs(v) < float("inf"))
            & F.forall(digital, lambda v: v.isin(0.0, 1.0)) & (F.get("_n", F.lit(len(numeric) - 1)) >= 0))

    def code(name: Column, i: Column) -> Column:
        raw, v = F.get("_c", i + 1), F.get("_n", i)
        failed = (F.when(raw.isNull(), F.lit("missing_field:"))
                  .when(F.lower(raw).rlike(NON_FINITE) | (F.abs(v) == float("inf")), F.lit("non_finite:"))
                  .when(v.isNull(), F.lit("unparseable:"))
                  .when((i >= n_analog) & (i < n_analog + n_digital) & ~v.isin(0.0, 1.0), F.lit("not_0_1:"))
                  .when((i == len(numeric) - 1) & (v < 0), F.lit("invalid_impulse:")))
        return F.concat(failed, name)
    raw_ts = F.trim(F.get("_c", F.lit(0)))
    bad_ts = (F.when(F.col("_ts").isNotNull(), F.lit(None).cast("string"))
              .when(raw_ts.rlike(ZONE_SUFFIX) & ~raw_ts.rlike(ISO_NAIVE), F.lit("timezone")).otherwise(F.lit("bad_timestamp")))
    each = F.concat(F.array(bad_ts), F.transform(F.array(*[F.lit(n) for n in numeric]), code))
    none = F.array().cast("array<string>")
    # a blank, open or short record is reported alone (the field checks would only repeat it)
    violations = (F.when(F.coalesce(fine, F.lit(False)), none)
                  .when(F.col("line").rlike(r'^[\s,"]*$'), F.array(F.lit("blank_row")))
                  .when(~F.col("closed"), F.array(F.lit("open_quote")))
                  .when(F.col("_short"), F.array(F.lit("short_row")))
                  .otherwise(F.filter(each, lambda x: x.isNotNull())))
    checked = typed.select("source_row", "line", "_ts", "_n", violations.alias("violations"))
    at = lambda k: F.get("_n", F.lit(k))
    out = [F.col("source_row"), F.col("_ts").alias("observed_at")]
    out += [at(k).alias(a) for k, a in enumerate(schema.analog)]
    out += [F.when(at(k).isin(0.0, 1.0), at(k).cast("smallint")).alias(d) for k, d in enumerate(schema.digital, n_analog)]
    out += [F.when(at(len(numeric) - 1) >= 0, at(len(numeric) - 1)).alias(schema.impulse)]
    return checked.select(*out, F.when(F.size("violations") > 0, F.col("line")).alias("line"), "violations")


@dataclass
class IngestResult:
    valid: DataFrame
    quarantine: DataFrame
    headers: list[str]


def scan_csv(spark: SparkSession, path: str, schema: ReadingSchema = READING_SCHEMA) -> IngestResult:
    """Text scan -> numbered records -> fields by each file's own header -> typed rows + quarantine.

    Files may order their columns differently; a file whose header lacks a field or has one twice is fatal. An
    all-empty record is ``blank_row``, a record whose quote is never closed ``open_quote``. The typed rows are written once; the
    result reads that table.
    """
    with fixed_splits(spark):
        splits = split_table(spark, path)
        several, written = splits.filter("_odd_lines > 0").limit(1).count() > 0, [splits]
        keep = lambda df, name: written.append(materialize(df, name)) or written[-1]
        plain = splits.filter("_odd_lines = 0")
        heads = plain.filter("block = 0").select("file", "header", "_data")
        if several:
            records = keep(joined_records(spark, path, splits), "csv_records")
            heads = heads.unionByName(records.groupBy("file").agg(F.min_by("value", "rec_no").alias("header"),
                                                                  F.max("rec_no").alias("_data")))
        order = keep(header_table(heads, schema), "csv_headers")
        found = order.agg(F.min_by("_error", F.when(F.col("_error").isNotNull(), F.col("header"))).alias("error"), F.min("header").alias("first")).first()
        if found.error:
            raise IngestError(found.error)
        if found.first is None:
            raise IngestError("CSV is empty")
        # data rows of the files before each file, and the places of its fields
        earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        files = (heads.withColumn("_start", F.coalesce(F.sum("_data").over(earlier), F.lit(0)))
                 .join(order, "header").select("file", "_start", "_at"))
        lookup = keep(plain.select("file", "block", "_mid0", "_off").join(files, "file"), "csv_lookup")
        number = F.col("_off") + F.col("_mid") - F.col("_mid0")
        lines = _looked_up(_text(spark, path), lookup).select(
            (F.col("_start") + number).alias("source_row"), number.alias("_no"), F.col("value").alias("line"), F.lit(True).alias("closed"), "_at")
        if several:
            lines = lines.unionByName(records.join(files, "file").select(
                (F.col("_start") + F.col("rec_no")).alias("source_row"), F.col("rec_no").alias("_no"), F.col("value").alias("line"), "closed", "_at"))
        data = lines.filter("_no > 0").select("source_row", "line", "closed", "_at", fields_of(F.col("line")).alias("_cells"))
        rows = materialize(typed_with_violations(data, schema), "csv_rows")
        discard(*written)
    valid = rows.filter(F.size("violations") == 0).drop("violations", "line")
    quarantine = rows.filter(F.size("violations") > 0).select("source_row", "line", "violations")
    return IngestResult(valid, quarantine, found.first.lstrip("\ufeff").split(","))


def fail_fast(result: IngestResult) -> DataFrame:
    """Raise on the first (smallest ``source_row``) bad row, naming it; else return valid rows."""
    first = result.quarantine.orderBy("source_row").select("source_row", "violations").limit(1).collect()
    if first:
        r = first[0]
        raise IngestError(f"Invalid CSV row {r['source_row']}: {', '.join(r['violations'])}")
    return result.valid


def completeness_gate(rows: DataFrame, expected: int | None, allow_subset: bool = False) -> DataFrame:
    """One row ``(row_count, expected_rows, allow_subset, passes)``; zero rows never pass."""
    n = F.count(F.lit(1))
    exp = F.lit(expected).cast("bigint")
    passes = (n > 0) & (F.lit(allow_subset) | (n == exp)) if expected is not None else (n > 0)
    return rows.agg(n.alias("row_count"), exp.alias("expected_rows"), F.lit(allow_subset).alias("allow_subset"),
                    F.coalesce(passes, F.lit(False)).alias("passes"))


def assert_complete(gate: DataFrame) -> None:
    r = gate.first()
    if not r["passes"]:
        raise IngestError(f"{r['row_count']} rows came in where {r['expected_rows']} were announced; "
                          "load the whole source, or allow a subset in tests")
