"""Sinks: append (S3), keyed upsert (S4), cleaned-text export (S5) and
delimited export (S6).

All writes are distributed (one file per task); nothing is funnelled
through one partition or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_text
from ..operators.unique import ids_unique
from .tables import _is_path


def append(df: DataFrame, target: str | None, fmt: str = "parquet", namespace: str | None = None) -> bool:
    """Append ``df`` to a table name (in ``namespace`` if unqualified) or to
    a path. An empty or missing target writes nothing, as in the original.
    An existing table keeps its own format and takes columns by name (the
    same names are needed); ``fmt`` holds for paths and new tables.
    Returns whether a write happened."""
    if not target:
        return False
    if _is_path(target):
        df.write.mode("append").format(fmt).save(target)
        return True
    spark = df.sparkSession
    name = target if (namespace is None or "." in target) else f"{namespace}.{target}"
    if spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
            raise ValueError(f"{name} has the columns {columns}, not {df.columns}")
        df.select(*[F.col(f"`{c}`") for c in columns]).write.insertInto(name)
    else:
        df.write.format(fmt).saveAsTable(name)
    return True


def upserted(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert as a lazy DataFrame (S4).

    For a key present in ``updates`` every column that ``updates`` has takes
    the update's value; columns only ``existing`` has keep their values;
    keys only in ``existing`` are unchanged; new keys are added. This is the
    row-level behaviour of an insert into a keyed store, where writing a row
    with some columns leaves the others in place.

    One full outer join on the keys (a shuffle of both sides by key). Several
    updates for one key fail the job, as no row order says which is the last.
    """
    keys = list(keys)
    missing = [k for k in keys if k not in existing.columns or k not in updates.columns]
    if missing:
        raise ValueError(f"keys {missing} must be columns of both frames")
    old = existing.select(*[F.col(c).alias(f"_o_{c}") for c in existing.columns])
    each = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*updates.columns)).alias("_row"))
    several = F.raise_error(F.lit(f"several updates for one key {keys}"))
    each = each.select(F.when(F.col("_n") > 1, several).otherwise(F.col("_row")).alias("_row"))
    new = each.select(*[F.col(f"_row.{c}").alias(f"_n_{c}") for c in updates.columns]).withColumn("_n_present", F.lit(True))
    cond = None
    for k in keys:
        part = old[f"_o_{k}"].eqNullSafe(new[f"_n_{k}"])
        cond = part if cond is None else cond & part
    j = old.join(new, cond, "full_outer")
    present = F.col("_n_present").isNotNull()
    out = []
    seen = set()
    for c in list(existing.columns) + [c for c in updates.columns if c not in existing.columns]:
        if c in seen:
            continue
        seen.add(c)
        in_old, in_new = c in existing.columns, c in updates.columns
        if in_old and in_new:
            out.append(F.when(present, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
        elif in_old:
            out.append(F.col(f"_o_{c}").alias(c))
        else:
            out.append(F.col(f"_n_{c}").alias(c))
    return j.select(*out)


def upsert(spark: SparkSession, existing_path: str, updates: DataFrame, keys: Sequence[str], out_path: str,
           fmt: str = "parquet") -> DataFrame:
    """Apply :func:`upserted` to the table at ``existing_path`` and write the
    result to ``out_path`` (a new location: a Parquet path cannot be
    rewritten while it is being read). Returns the written table, read back."""
    if out_path.rstrip("/") == existing_path.rstrip("/"):
        raise ValueError("out_path must differ from existing_path")
    existing = spark.read.format(fmt).load(existing_path)
    upserted(existing, updates, keys).write.mode("errorifexists").format(fmt).save(out_path)
    return spark.read.format(fmt).load(out_path)


def cleaned_texts(df: DataFrame, id_col: str, text_col: str, one_per_id: bool | None = None) -> DataFrame:
    """What the cleaned-text export writes (S5): ``id`` and cleaned ``text``
    for rows whose cleaned text is not empty; null texts are skipped.

    A null id fails the job (the original failed on it too), also beside a
    null or empty text, before any output is committed. The original wrote one file per id, so rows sharing
    an id overwrote each other in whatever order they ran; here the greatest
    cleaned text per id is kept, which is repeatable. That needs a shuffle of
    all cleaned texts by id, so ``one_per_id=None`` (the default) first
    checks with :func:`linetally.operators.unique.ids_unique`, which shuffles no ids where the splits of the table hold
    different stretches of them, and skips the shuffle when ids are
    already unique; ``True`` / ``False`` force the choice without the check.
    """
    ident, cleaned = F.col(id_col), clean_text(F.col(text_col).cast(T.StringType()))
    # one expression, so that no filter on the text runs before the check of the id
    null_id = F.raise_error(F.lit(f"null value in id column {id_col}")).cast("boolean")
    wanted = F.when(ident.isNull(), null_id).otherwise(F.col(text_col).isNotNull() & (cleaned != F.lit("")))
    rows = df.where(wanted).select(ident.alias("id"), cleaned.alias("text"))
    if one_per_id is None:
        one_per_id = not ids_unique(df, id_col)
    if one_per_id:
        rows = rows.groupBy("id").agg(F.max("text").alias("text"))
    return rows


def export_cleaned_texts(df: DataFrame, id_col: str, text_col: str, path: str, fmt: str = "parquet",
                         one_per_id: bool | None = None, mode: str = "errorifexists") -> None:
    """Write :func:`cleaned_texts` to ``path`` on shared storage. ``fmt`` may
    be parquet, json, orc or csv."""
    cleaned_texts(df, id_col, text_col, one_per_id).write.mode(mode).format(fmt).save(path)


#: Fixed codes of what would break a line: a backslash and a letter for each.
_CODES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0"))


#: Times keep their microseconds.
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _texts(df: DataFrame, convert) -> DataFrame:
    """``df`` with ``convert`` applied to its string columns."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[convert(F.col(f"`{c}`")).alias(c) if isinstance(kinds[c], T.StringType) else F.col(f"`{c}`") for c in df.columns])


def line_safe(text: Column) -> Column:
    """The text on one line: backslash, line feed, carriage return and null character become two-character codes."""
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def from_line_safe(text: Column) -> Column:
    """The text that :func:`line_safe` coded. A backslash in it is always the first of two, so codes can be replaced one kind after the other, backslashes last."""
    for plain, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def export_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True, mode: str = "errorifexists") -> None:
    """Delimited text with a header (S6), one file per task (the original
    forced a single partition, which does not scale). A record is a line, so that files split for reading:
    line breaks (and backslashes) in texts are coded by :func:`line_safe`. Texts are written whole:
    blanks at their ends stay, quotes are doubled."""
    writer = _texts(df, line_safe).write.mode(mode).option("sep", sep).option("header", header).option("escape", '"').options(**_TIMES)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|",
                   header: bool = True) -> DataFrame:
    """Read back a delimited export with an explicit schema (no inference). Files are split
    at lines, so a large one is read by many tasks. An empty text (quoted in the file)
    and a null (nothing) stay apart."""
    empty = "\x00"  # what the reader gives for a quoted empty text, which it would else make null; in files this character is coded
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("escape", '"')
    rows = reader.option("emptyValue", empty).options(**_TIMES).csv(path)
    return _texts(rows, lambda v: F.when(v == empty, F.lit("")).otherwise(from_line_safe(v)))
