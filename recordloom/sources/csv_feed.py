"""CSV feed: scan with row numbers, content fingerprints, and resume points.

A file is known by its whole path; files of one name in several folders are different files.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MALFORMED = "_malformed"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _splits(lines: DataFrame) -> DataFrame:
    """Per input split of ``lines`` (file, block, mid, value): its first counter, the rows of the file's splits before it,
    and the file's header line, which is the first line of its first split."""
    per_block = lines.groupBy("_file", "_block").agg(
        F.min("_mid").alias("_first"), F.count("*").alias("_rows"),
        F.min_by("value", F.when(F.col("_block") == 0, F.col("_mid"))).alias("_head"),
    )
    of_file = Window.partitionBy("_file")
    before = of_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.max("_head").over(of_file).alias("_header")
    )


def _names(header: str) -> list[str]:
    return [n.strip().lstrip("\ufeff") for n in next(csv.reader([header or ""]), [])]


_PLACE = {"_file_path": "string", "_file_name": "string", "_row_number": "bigint"}


def read_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """All-text scan by header names; adds ``_file_path`` (what identifies the file), ``_file_name`` (its last part),
    ``_row_number`` (1-based per file) and ``_extra_fields`` (the row had more fields than the header).

    ``columns`` come first, NULL where a file does not have them; other columns of the headers follow
    under their own names. A path that does not exist gives no rows. One scan reads all files, whatever their headers, and files
    stay splittable: row numbers come from each split's own counter plus the rows of the splits before it. Only the
    distinct header lines come to the driver. (``multi_line=True`` allows line breaks inside quotes at the price of one task per
    file, and of one scan per distinct header.)
    """
    try:
        text = spark.read.text(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        ddl = [f"`{c}` STRING" for c in columns] + ["_extra_fields BOOLEAN"] + [f"{c} {t}" for c, t in _PLACE.items()]
        return spark.createDataFrame([], ", ".join(ddl))
    lines = _numbered(text.select("value", *file_columns()))
    if not multi_line:
        return parse_lines(lines, columns)
    splits = _splits(lines)
    forms, others = _forms(splits, columns)
    frames = [_scanned(spark, path, splits, h, names, columns, others) for h, names in forms.items()]
    return reduce(DataFrame.unionByName, frames) if frames else parse_lines(lines, columns)


def file_columns() -> list[Column]:
    """What tells the lines of different files and splits apart, for a scan or a stream of text."""
    meta = F.col("_metadata")
    return [
        meta["file_path"].alias("_file"), meta["file_block_start"].alias("_block"), meta["file_modification_time"].alias("_time")
    ]


def _numbered(lines: DataFrame) -> DataFrame:
    """The lines with something in them, and the counter of their task."""
    return lines.filter(F.col("value").rlike(r"[^\x00-\x20]")).withColumn("_mid", F.monotonically_increasing_id())


def _forms(splits: DataFrame, columns: Sequence[str]) -> tuple[dict[str, list[str]], list[str]]:
    """Column names per distinct header line, and all names beyond ``columns``."""
    headers = sorted(r[0] for r in splits.select("_header").distinct().collect() if r[0] is not None)
    forms = {h: _names(h) for h in headers}
    return forms, list(dict.fromkeys(n for names in forms.values() for n in names if n not in columns))


def parse_batch(batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a micro-batch of whole files, read as text with ``file_columns``; ``_row_pos`` and ``_row_file`` give their order."""
    rows = parse_lines(_numbered(batch), columns, timed=True)
    file = F.struct(F.col("_time").alias("time"), F.col("_file_path").alias("path"), F.lit(0).cast("bigint").alias("block"))
    return rows.withColumns({"_row_pos": F.col("_row_number"), "_row_file": file}).drop("_time")


def parse_lines(lines: DataFrame, columns: Sequence[str], timed: bool = False) -> DataFrame:
    """Rows of numbered lines of whole files, each parsed under its own file's header."""
    splits = _splits(lines)
    forms, others = _forms(splits, columns)
    # One row per input split, sent whole: shuffling the lines to it would put each split into one task again.
    rows = lines.join(F.broadcast(splits), ["_file", "_block"]).filter((F.col("_block") > 0) | (F.col("_mid") > F.col("_first")))
    # The header is one of the lines before, so the first row after it has number 1.
    rows = rows.withColumn("_row_number", F.col("_before") + F.col("_mid") - F.col("_first"))
    # A row is parsed under its own file's header only; a stage of its own keeps the parser from running per field.
    parsed = {f"_form{k}": F.when(F.col("_header") == h, F.from_csv("value", _ddl(names), _OPTIONS)) for k, (h, names) in enumerate(forms.items())}
    rows = rows.withColumns(parsed)
    held = [_held(lambda n, k=k: F.col(f"_form{k}")[n], names) for k, names in enumerate(forms.values())]
    present = [F.col(f"_form{k}").isNotNull() for k in range(len(forms))]

    def chosen(pick: Callable[[dict[str, Column]], Column | None], kind: str) -> Column:
        found = [F.when(here, value) for here, row in zip(present, held) if (value := pick(row)) is not None]
        return F.coalesce(*found, F.lit(None).cast(kind))

    return rows.select(
        *[chosen(lambda row, c=c: row.get(c), "string").alias(c) for c in [*columns, *others]],
        chosen(lambda row: row[_EXTRA], "boolean").alias("_extra_fields"),
        F.col("_file").alias("_file_path"), F.element_at(F.split("_file", "/"), -1).alias("_file_name"), "_row_number",
        *(["_time"] if timed else []),
    )


_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MALFORMED}
_EXTRA = " extra"


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` STRING" for c in [*names, _MALFORMED])


def _held(field: Callable[[str], Column], names: Sequence[str]) -> dict[str, Column]:
    """Value per column, and whether the row has fields beyond the header.

    An empty field reads as NULL; only a field the row does not have is really missing.
    """
    whole = field(_MALFORMED).isNull()
    values = {c: F.when(whole, F.coalesce(field(c), F.lit(""))).otherwise(field(c)) for c in names}
    return {**values, _EXTRA: ~whole & field(names[-1]).isNotNull()}


def _scanned(
    spark: SparkSession, path: str | Sequence[str], splits: DataFrame, header: str, names: list[str], columns: Sequence[str], others: Sequence[str]
) -> DataFrame:
    """The rows of the files of one header, with line breaks inside quotes."""
    scan = spark.read.schema(_ddl(names)).options(header=True, multiLine=True, **_OPTIONS).csv(path)
    held = _held(F.col, names)
    none = F.lit(None).cast("string")
    rows = scan.select(
        *[held.get(c, none).alias(c) for c in [*columns, *others]], held[_EXTRA].alias("_extra_fields"),
        F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_name").alias("_file_name"), F.monotonically_increasing_id().alias("_mid"),
    )
    mine = splits.filter(F.col("_header") == header).select(F.col("_file").alias("_file_path")).distinct()
    first = scan.select(F.col("_metadata.file_path").alias("_file_path"), F.monotonically_increasing_id().alias("_mid"))
    first = first.groupBy("_file_path").agg(F.min("_mid").alias("_first")).join(mine, "_file_path", "left_semi")
    return rows.join(first, "_file_path").withColumn("_row_number", F.col("_mid") - F.col("_first") + 1).drop("_mid", "_first")


def extra_fields_rule() -> Column:
    """Violation for ``validate_text``: a row longer than the header."""
    return F.when(F.col("_extra_fields"), F.lit("record: more fields than the header"))


def file_fingerprints(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, length, fingerprint): MD5 of each file's bytes. Each file is one row, so this suits
    files of up to some hundred MB; larger ones go through ``content_fingerprints``."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.col("path").alias("file"), "length", F.md5("content").alias("fingerprint"))
    )


def content_fingerprints(spark: SparkSession, path: str | Sequence[str], parts: bool = False) -> DataFrame:
    """(file, lines, fingerprint) of whole files, digested in parallel. With ``parts`` the files of a folder, in the order of
    their names, are one file that bears the folder's path; so a file of any size can be written by several tasks.

    The digest of a stretch of lines is its length n and four sums of h(line) * base^place modulo a prime; stretches combine by
    concatenation, (n1, s1) and (n2, s2) to (n1 + n2, s1 + base^n1 * s2). So each split is digested by itself, any cut into
    splits gives the same value, and lines in another order give another one. The lines end at line feeds; a carriage return
    is part of its line. A path that does not exist gives no rows.
    """
    try:
        text = spark.read.option("lineSep", "\n").text(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], "file string, lines bigint, fingerprint string")
    meta = F.col("_metadata")
    file, block = meta["file_path"], meta["file_block_start"]
    if parts:
        file, block = F.regexp_replace(file, r"/[^/]*$", ""), F.struct(file.alias("part"), block.alias("start"))
    lines = text.select(
        file.alias("file"), block.alias("block"), F.md5("value").alias("h"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    return ordered_digest(lines)


def ordered_digest(lines: DataFrame) -> DataFrame:
    """Order-aware digest per ``file`` of the MD5 texts ``h``; ``place`` counts through every ``block`` of a file."""
    word = [F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("bigint") % PRIME for k in range(len(BASES))]
    terms = [word[k] * power(base, F.col("place")) % PRIME for k, base in enumerate(BASES)]
    splits = lines.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.min("place").alias("first"), *[F.sum(t).alias(f"s{k}") for k, t in enumerate(terms)]
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A split counted from where its task stood; exponents are taken modulo the order of the group, so they may be negative.
    shift = F.pmod(F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"), F.lit(PRIME - 1))
    placed = splits.withColumn("shift", shift)
    moved = [(F.col(f"s{k}") % PRIME) * power(base, F.col("shift")) % PRIME for k, base in enumerate(BASES)]
    whole = placed.groupBy("file").agg(F.sum("n").alias("lines"), *[(F.sum(m) % PRIME).alias(f"d{k}") for k, m in enumerate(moved)])
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("lines", *[f"d{k}" for k in range(len(BASES))])])
    return whole.select("file", "lines", F.md5(text).alias("fingerprint"))


#: The field of the digest, and a generator of its own for each word of a line's MD5.
PRIME = (1 << 31) - 1
BASES = (48271, 69621, 16807, 39373)
_DIGIT = 6


def power(base: int, exponent: Column, bits: int = 36) -> Column:
    """base^exponent modulo the prime, as a product of looked-up powers of the exponent's digits."""
    result = F.lit(1).cast("bigint")
    for shift in range(0, bits, _DIGIT):
        step = pow(base, 1 << shift, PRIME)
        table = ",".join(str(pow(step, digit, PRIME)) for digit in range(1 << _DIGIT))
        powers = F.split(F.lit(table), ",").cast("array<bigint>")  # folded to a constant by the optimizer
        digit = F.shiftright(exponent, shift).bitwiseAND(F.lit((1 << _DIGIT) - 1)).cast("int")
        result = result * F.get(powers, digit) % PRIME
    return result


def line_digest(lines: DataFrame, *keys: str) -> DataFrame:
    """Digest per key of the MD5 texts ``h``, whatever their order: their count and the sums of their four 32-bit words."""
    words = [F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    sums = lines.groupBy(*keys).agg(F.count("*").alias("lines"), *[F.sum(w).alias(f"w{k}") for k, w in enumerate(words)])
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("lines", "w0", "w1", "w2", "w3")])
    return sums.select(*keys, "lines", F.md5(text).alias("fingerprint"))


def parse_csv_checkpoint(value: Column) -> Column:
    """Struct (start_row, fingerprint) of a ``"<row>|<fingerprint>"`` checkpoint; malformed is row 0."""
    parts = F.split(value, r"\|")
    row = F.get(parts, F.lit(0))
    return F.struct(
        F.coalesce(F.when(row.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(row).try_cast("bigint")), F.lit(0).cast("bigint")).alias("start_row"),
        F.nullif(F.get(parts, F.lit(1)), F.lit("")).alias("fingerprint"),
    )


def resume_points(files: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Start row per file: the checkpointed row, or 0 when the file is new or its content changed.

    ``files``: (file, fingerprint); ``checkpoints``: (file, last_value).
    """
    known = checkpoints.select("file", parse_csv_checkpoint(F.col("last_value")).alias("c"))
    changed = F.col("c.fingerprint").isNotNull() & (F.col("c.fingerprint") != F.col("fingerprint"))
    points = files.join(known, "file", "left").select(
        "file",
        "fingerprint",
        F.when(changed, F.lit(0)).otherwise(F.coalesce("c.start_row", F.lit(0))).cast("bigint").alias("start_row"),
    )
    # One point per file: of several checkpoints of a file the earliest counts, so that none multiplies or skips rows.
    return points.groupBy("file", "fingerprint").agg(F.min("start_row").alias("start_row"))


def rows_after(rows: DataFrame, points: DataFrame, file: str = "_file_path") -> DataFrame:
    """Rows beyond their file's start row. ``points`` has one row per file."""
    at = points.select(F.col("file").alias(file), "start_row")
    return rows.join(at, file, "left").filter(
        F.col("_row_number") > F.coalesce("start_row", F.lit(0))
    ).drop("start_row")


def csv_checkpoint(end_row: Column, fingerprint: Column) -> Column:
    return F.concat(end_row.cast("string"), F.lit("|"), fingerprint)
