"""

``entry(spark)`` runs the flagship query (the text profile) on sf0.001;
``queries()`` maps each implemented operator to a callable
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives, for each of them,
the same result as DuckDB SQL over the raw tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linetally.functions.buckets import parse_double, percentage_bucket  # noqa: E402
from linetally.functions.text import DISALLOWED_RUN, clean_text  # noqa: E402
from linetally.operators import profile as prof  # noqa: E402
from linetally.operators.clients import client_report  # noqa: E402
from linetally.operators.extract import filter_rows  # noqa: E402
from linetally.operators.idlists import text_id_chunks  # noqa: E402
from linetally.operators.pareto import pareto  # noqa: E402
from linetally.operators.report import text_report  # noqa: E402
from linetally.plans.jobs import Source, extract_job  # noqa: E402
from linetally.schema import DEFAULT_ID_SPAN, PARETO_SHARE, PROFILE_COLUMNS, UNDEFINED_CATEGORY, LineColumns  # noqa: E402
from linetally.session import scratch_path  # noqa: E402
from linetally.sources import fixtures, sinks  # noqa: E402
from linetally.sources.keyed import KeyedTable  # noqa: E402
from linetally.sources.fixtures import DOCUMENT_LINES_SQL, STATEMENT_LINES_SQL  # noqa: E402
from linetally.streaming.profile_stream import start_text_groups_stream  # noqa: E402
from linetally.sources.tables import row_count, scan  # noqa: E402

try:  # the training-data operators are an optional subpackage
    import corpus_pipeline  # noqa: E402
    from linetally.llm import queries as llm_queries  # noqa: E402
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "linetally.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the text profile (compatible mode) of the statement lines."""
    return prof.text_profile(fixtures.statement_lines(spark, SMOKE_DIR), CENTS, compat=True)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


# Amounts of the test tables are whole cents; as an exact type their sums do
# not depend on the order of partitions, so both engines agree to the last bit.
class CentColumns(LineColumns):
    amount_type = "decimal(18,2)"


CENTS = CentColumns()


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.statement_lines(spark, sf_dir)


def q_row_count(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    return row_count(scan(spark, events, where="event_type <> 'error'"))


def q_scan_where_limit(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    return scan(
        spark,
        events,
        fields="event_id, user_id, value",
        where="value > 100 AND event_type IN ('click', 'view')",
        limit=50,
        order_by=[F.col("value").desc(), F.col("event_id")],
    )


def q_clean_documents(spark, sf_dir):
    docs = fixtures.documents(spark, sf_dir)
    return docs.select("doc_id", clean_text("text").alias("clean"))


def q_percentage_bucket(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    pct = parse_double(F.get_json_object("props", "$.k"))
    return events.select(
        "event_id",
        pct.alias("category_pct"),
        percentage_bucket(pct).alias("category_percentual_quartil"),
    )


def _day_parts(compat: bool):
    def run(spark, sf_dir):
        g = prof.text_groups(_lines(spark, sf_dir), CENTS)
        noite = "n_noite_compat" if compat else "n_noite_fixed"
        return g.select(
            "text",
            F.col("n_dia").alias("count_dia"),
            F.col("n_tarde").alias("count_tarde"),
            F.col(noite).alias("count_noite"),
            F.col("n_madrugada").alias("count_madrugada"),
        )

    return run


def q_totals(spark, sf_dir):
    return prof.text_totals(_lines(spark, sf_dir), CENTS)


def q_text_counts(spark, sf_dir):
    return prof.text_counts(_lines(spark, sf_dir), CENTS)


def q_text_representative(spark, sf_dir):
    g = prof.text_groups(_lines(spark, sf_dir), CENTS)
    return g.select("text", "category", F.col("quartil").alias("category_percentual_quartil"))


def q_text_shares(spark, sf_dir):
    p = prof.text_profile(_lines(spark, sf_dir), CENTS, compat=False)
    return p.select("text", "percentual_count", "percentual_amount", "percentual_dia",
                    "percentual_tarde", "percentual_noite", "percentual_madrugada")


def _profile(compat: bool):
    def run(spark, sf_dir):
        return prof.text_profile(_lines(spark, sf_dir), CENTS, compat=compat)

    return run


def q_text_ids(spark, sf_dir):
    return text_id_chunks(_lines(spark, sf_dir), CENTS, span=DEFAULT_ID_SPAN)


def q_document_text_counts(spark, sf_dir):
    return prof.text_counts(fixtures.document_lines(spark, sf_dir), CENTS)


def _extract(kind: str):
    column, values = EXTRACTS[kind]

    def run(spark, sf_dir):
        return filter_rows(_lines(spark, sf_dir), column, kind, values)

    return run


EXTRACTS = {
    "in": ("category", ["INDEFINIDO", "click"]),
    "greater": ("amount", ["400"]),
    "between": ("category_pct", ["25", "50"]),
}


def _pareto_report(spark, sf_dir, compat=True):
    return pareto(prof.grouped(_lines(spark, sf_dir), CENTS), PARETO_SHARE, compat)


def q_pareto_amount(spark, sf_dir):
    return _pareto_report(spark, sf_dir).selection("amount")


def q_pareto_count(spark, sf_dir):
    return _pareto_report(spark, sf_dir).selection("count")


def q_pareto_flags(spark, sf_dir):
    return _pareto_report(spark, sf_dir).flags()


def q_pareto_summary(spark, sf_dir):
    return _pareto_report(spark, sf_dir).summary()


def q_client_profile(spark, sf_dir):
    return client_report(_lines(spark, sf_dir), CENTS)[0]


def q_client_lists(spark, sf_dir):
    return client_report(_lines(spark, sf_dir), CENTS)[1]


def q_cleaned_export(spark, sf_dir):
    path = scratch_path(spark, "cleaned-export")
    sinks.export_cleaned_texts(fixtures.documents(spark, sf_dir), "doc_id", "text", path)
    return spark.read.parquet(path)


def q_cleaned_export_repeated(spark, sf_dir):
    """Ids that repeat, some in neighbouring rows and some far apart: the greatest text of each id is kept."""
    docs = fixtures.documents(spark, sf_dir).withColumn("doc_id", F.floor(F.col("doc_id") / 2) % 300)
    path = scratch_path(spark, "cleaned-export")
    sinks.export_cleaned_texts(docs, "doc_id", "text", path)
    return spark.read.parquet(path)


def q_extract_job(spark, sf_dir):
    """The whole extract job: table, delimited copy and returned rows, which have to agree."""
    table, delimited = scratch_path(spark, "extract-table"), scratch_path(spark, "extract-delimited")
    rows = extract_job(spark, Source(_lines(spark, sf_dir)), "category_pct", "between", ["25", "50"], table, delimited)
    copies = [spark.read.parquet(table), sinks.read_delimited(spark, delimited, rows.schema)]
    return rows.intersectAll(copies[0]).intersectAll(copies[1])


def q_append_roundtrip(spark, sf_dir):
    rows = _extract("between")(spark, sf_dir)
    path = scratch_path(spark, "append")
    sinks.append(rows, path)
    sinks.append(rows, path)
    return spark.read.parquet(path)


def q_upsert_roundtrip(spark, sf_dir):
    groups = prof.grouped(_lines(spark, sf_dir), CENTS)
    base = scratch_path(spark, "upsert-base")
    prof.profile_from_groups(groups, compat=True).write.parquet(base)
    selected = pareto(groups).selection("amount").select("text", F.lit(1).alias("pareto_amount"))
    return sinks.upsert(spark, base, selected, ["text"], scratch_path(spark, "upsert-out"))


def q_keyed_upsert(spark, sf_dir):
    """Both selections' flags set one after the other; only the buckets of the selected texts are rewritten."""
    groups = prof.grouped(_lines(spark, sf_dir), CENTS)
    table = KeyedTable.create(prof.profile_from_groups(groups, compat=True), scratch_path(spark, "keyed"), ["text"], buckets=32)
    report = pareto(groups)
    for by in ("amount", "count"):
        table.upsert(report.selection(by).select("text", F.lit(1).alias(f"pareto_{by}")))
    return table.read()


def q_delimited_roundtrip(spark, sf_dir):
    profile = prof.text_profile(_lines(spark, sf_dir), CENTS, compat=False)
    path = scratch_path(spark, "delimited")
    sinks.export_delimited(profile, path)
    return sinks.read_delimited(spark, path, profile.schema)


def q_delimited_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = scratch_path(spark, "delimited")
    sinks.export_delimited(docs, path)
    return sinks.read_delimited(spark, path, docs.schema)


def q_document_pareto_count(spark, sf_dir):
    groups = prof.grouped(fixtures.document_lines(spark, sf_dir), CENTS, strict=False)
    return pareto(groups, PARETO_SHARE, compat=True).selection("count")


_GROUP_COLUMNS = ("text", "cnt", "amount", "undefined_count", "undefined_amount", "first_id", "category",
                  "quartil", "n_madrugada", "n_dia", "n_tarde", "n_noite_compat", "n_noite_fixed")


def q_stream_text_groups(spark, sf_dir):
    snapshot = scratch_path(spark, "stream-snapshot")
    query = start_text_groups_stream(fixtures.statement_lines_stream(spark, sf_dir), CENTS, snapshot_path=snapshot,
                                     available_now=True,
                                     state_partitions=spark.sparkContext.defaultParallelism)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    groups = spark.read.parquet(snapshot)
    return groups.select(*[F.col(c).cast("double").alias(c) if c in ("amount", "undefined_amount") else c
                           for c in _GROUP_COLUMNS])


def q_report_profile(spark, sf_dir):
    return text_report(_lines(spark, sf_dir), CENTS).profile(compat=True)


def q_report_ids(spark, sf_dir):
    return text_report(_lines(spark, sf_dir), CENTS).id_chunks()


def q_text_counts_fractions(spark, sf_dir):
    """Amounts with more than two decimals, summed unrounded; only the finished sum is rounded, to compare."""
    lines = _lines(spark, sf_dir).withColumn("amount", F.col("amount") / 7)
    return prof.text_counts(lines).withColumn("amount", F.round("amount", 6))


def _repeated(spark, sf_dir):
    """Lines whose ids repeat: one id in a third of all lines, others twice; percentages partly out of range; amounts of many binary places."""
    lines = _lines(spark, sf_dir)
    return lines.withColumns({
        "row_id": F.when(F.col("row_id") % 3 == 0, F.lit(7)).otherwise(F.floor(F.col("row_id") / 2)),
        "category_pct": F.col("category_pct") * 3 - 50, "amount": F.col("amount") / 7})


def q_text_representative_repeated(spark, sf_dir):
    groups = prof.text_groups(_repeated(spark, sf_dir))
    return groups.select("text", "first_id", "category", F.col("quartil").alias("category_percentual_quartil"))


def q_text_ids_repeated(spark, sf_dir):
    return text_id_chunks(_repeated(spark, sf_dir), span=16)


def q_profile_doubles(spark, sf_dir):
    """Sums of plain doubles, exact and rounded once."""
    return prof.text_profile(_repeated(spark, sf_dir), compat=False).select("text", "count", "amount", "percentual_amount")


def q_totals_doubles(spark, sf_dir):
    return prof.text_totals(_repeated(spark, sf_dir))


def q_client_lists_strings(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("user_id", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return client_report(lines, CENTS, span=16)[1]


def q_client_profile_nulls(spark, sf_dir):
    """Lines without institution are a group like any other; user ids are strings."""
    lines = _lines(spark, sf_dir)
    some = F.when(F.col("row_id") % 3 != 0, F.col("institution"))
    lines = lines.withColumns({"institution": some, "user_id": F.concat(F.lit("u"), F.col("user_id").cast("string"))})
    return client_report(lines, CENTS)[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        "row_count": q_row_count,
        "scan_where_limit": q_scan_where_limit,
        "clean_documents": q_clean_documents,
        "percentage_bucket": q_percentage_bucket,
        "day_part_compat": _day_parts(True),
        "day_part_fixed": _day_parts(False),
        "totals": q_totals,
        "text_counts": q_text_counts,
        "text_representative": q_text_representative,
        "text_shares": q_text_shares,
        "text_profile_compat": _profile(True),
        "text_profile_fixed": _profile(False),
        "text_ids": q_text_ids,
        "document_text_counts": q_document_text_counts,
        "extract_in": _extract("in"),
        "extract_greater": _extract("greater"),
        "extract_between": _extract("between"),
        "pareto_amount": q_pareto_amount,
        "pareto_count": q_pareto_count,
        "pareto_flags": q_pareto_flags,
        "pareto_summary": q_pareto_summary,
        "client_profile": q_client_profile,
        "client_lists": q_client_lists,
        "cleaned_export": q_cleaned_export,
        "cleaned_export_repeated": q_cleaned_export_repeated,
        "extract_job": q_extract_job,
        "append_roundtrip": q_append_roundtrip,
        "upsert_roundtrip": q_upsert_roundtrip,
        "keyed_upsert": q_keyed_upsert,
        "delimited_roundtrip": q_delimited_roundtrip,
        "delimited_documents": q_delimited_documents,
        "document_pareto_count": q_document_pareto_count,
        "stream_text_groups": q_stream_text_groups,
        "report_profile": q_report_profile,
        "report_ids": q_report_ids,
        "text_counts_fractions": q_text_counts_fractions,
        "client_profile_nulls": q_client_profile_nulls,
        "text_representative_repeated": q_text_representative_repeated,
        "text_ids_repeated": q_text_ids_repeated,
        "profile_doubles": q_profile_doubles,
        "totals_doubles": q_totals_doubles,
        "client_lists_strings": q_client_lists_strings,
    }
    if llm_queries is not None:
        own |= llm_queries.queries()
        own["pipeline"] = corpus_pipeline.run
    return own


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

_CLEAN = "trim(regexp_replace(lower({c}), '" + DISALLOWED_RUN + "', ' ', 'g'))"


def _clean_sql(c: str) -> str:
    return _CLEAN.format(c=c)


_BUCKET = """CASE WHEN {p} > 0 AND {p} <= 25 THEN 1
     WHEN {p} > 25 AND {p} <= 50 THEN 2
     WHEN {p} > 50 AND {p} <= 75 THEN 3
     WHEN {p} > 75 AND {p} <= 100 THEN 4 ELSE 0 END"""

_LINES = f"lines AS ({STATEMENT_LINES_SQL})"
_DOC_LINES = f"lines AS ({DOCUMENT_LINES_SQL})"

_PREPARED = f"""prepared AS (
  SELECT {_clean_sql('text')} AS text, row_id, CAST(amount AS DECIMAL(18,2)) AS amount, category,
         {_BUCKET.format(p='category_pct')} AS quartil, hour(ts) AS hour
  FROM lines
  WHERE row_id IS NOT NULL AND amount IS NOT NULL AND text IS NOT NULL AND category IS NOT NULL)"""

_GROUPS = f"""groups AS (
  SELECT text, count(*) AS cnt, sum(amount) AS amount, min(row_id) AS first_id,
         count(*) FILTER (WHERE category = '{UNDEFINED_CATEGORY}') AS undefined_count,
         coalesce(sum(amount) FILTER (WHERE category = '{UNDEFINED_CATEGORY}'), 0) AS undefined_amount,
         arg_min(category, row_id) AS category, arg_min(quartil, row_id) AS quartil,
         count(*) FILTER (WHERE hour >= 0 AND hour < 6) AS n_madrugada,
         count(*) FILTER (WHERE hour >= 6 AND hour < 12) AS n_dia,
         count(*) FILTER (WHERE hour >= 12 AND hour < 18) AS n_tarde,
         count(*) FILTER (WHERE NOT (hour >= 12 AND hour < 18)) AS n_noite_compat,
         count(*) FILTER (WHERE hour >= 18) AS n_noite_fixed
  FROM prepared GROUP BY text)"""

_WITH_GROUPS = f"WITH {_LINES},\n{_PREPARED},\n{_GROUPS}\n"
_WITH_DOC_GROUPS = f"WITH {_DOC_LINES},\n{_PREPARED},\n{_GROUPS}\n"


def _profile_select(compat: bool, keep_empty: bool = False) -> str:
    noite = "n_noite_compat" if compat else "n_noite_fixed"
    madr = "n_dia" if compat else "n_madrugada"
    where = "" if keep_empty else "WHERE g.text <> ''"
    return f"""SELECT g.text, CAST(g.cnt AS BIGINT) AS "count", CAST(g.amount AS DOUBLE) AS amount, g.category,
       CAST(g.cnt AS DOUBLE) / CAST(t.tot_cnt AS DOUBLE) AS percentual_count,
       CAST(g.amount AS DOUBLE) / CAST(t.tot_amount AS DOUBLE) AS percentual_amount,
       g.quartil AS category_percentual_quartil,
       CAST(g.n_dia AS BIGINT) AS count_dia, CAST(g.n_tarde AS BIGINT) AS count_tarde,
       CAST(g.{noite} AS BIGINT) AS count_noite, CAST(g.n_madrugada AS BIGINT) AS count_madrugada,
       CAST(g.n_dia AS DOUBLE) / CAST(g.cnt AS DOUBLE) AS percentual_dia,
       CAST(g.n_tarde AS DOUBLE) / CAST(g.cnt AS DOUBLE) AS percentual_tarde,
       CAST(g.{noite} AS DOUBLE) / CAST(g.cnt AS DOUBLE) AS percentual_noite,
       CAST(g.{madr} AS DOUBLE) / CAST(g.cnt AS DOUBLE) AS percentual_madrugada
FROM groups g CROSS JOIN (SELECT sum(cnt) AS tot_cnt, sum(amount) AS tot_amount FROM groups) t
{where}"""


def _profile_sql(compat: bool) -> str:
    return _WITH_GROUPS + _profile_select(compat)


_PROFILE_COLS = ", ".join(f'"{c}"' if c == "count" else c for c in PROFILE_COLUMNS)

def _ranked(with_groups: str) -> str:
    return with_groups + f""",
prof AS ({_profile_select(True)}),
sel AS (SELECT CAST(ceil(count(*) * CAST({PARETO_SHARE} AS DOUBLE)) AS BIGINT) AS n FROM groups),
ranked AS (
  SELECT p.*,
         row_number() OVER (ORDER BY percentual_amount DESC NULLS LAST, text) AS rank_amount,
         row_number() OVER (ORDER BY percentual_count DESC NULLS LAST, text) AS rank_count
  FROM prof p)
"""


_RANKED = _ranked(_WITH_GROUPS)


def _pareto_selection_sql(by: str, with_groups: str = _WITH_GROUPS) -> str:
    return _ranked(with_groups) + f"SELECT {_PROFILE_COLS}, rank_{by} AS rank FROM ranked, sel WHERE rank_{by} <= sel.n"


def _flags_sql() -> str:
    return _RANKED + f"""SELECT {_PROFILE_COLS},
       CASE WHEN rank_amount <= sel.n THEN 1 END AS pareto_amount,
       CASE WHEN rank_count <= sel.n THEN 1 END AS pareto_count
FROM ranked, sel"""


def _chunk_sql(c: str, span: int) -> str:
    return f"({c} - (({c} % {span}) + {span}) % {span}) // {span}"


def _id_chunks_sql(source: str, keys: str, ident: str, out: str, span: int = DEFAULT_ID_SPAN) -> str:
    """Id chunks by brute force: position of each id in its group's id range
    (row_number), cut into parts of `span` positions."""
    return f"""SELECT {keys}, chunk, part, min({ident}) AS first_id, max({ident}) AS last_id, count(*) AS n_ids,
       string_agg(CAST({ident} AS VARCHAR), '|' ORDER BY {ident}) AS {out}
FROM (SELECT {keys}, {ident}, chunk,
             (row_number() OVER (PARTITION BY {keys}, chunk ORDER BY {ident}) - 1) // {span} AS part
      FROM (SELECT {keys}, {ident}, {_chunk_sql(ident, span)} AS chunk FROM {source}))
GROUP BY ALL"""


_REPEATED = f"""repeated AS (
  SELECT {_clean_sql('text')} AS text, CASE WHEN row_id % 3 = 0 THEN 7 ELSE row_id // 2 END AS row_id, amount / 7 AS amount, category,
         {_BUCKET.format(p='(category_pct * 3 - 50)')} AS quartil
  FROM lines
  WHERE row_id IS NOT NULL AND amount IS NOT NULL AND text IS NOT NULL AND category IS NOT NULL)"""


def _exact_double(units: str) -> str:
    """The double nearest to a HUGEINT number of units of 2^-62: its leading 60 bits, the last one set if anything follows, and then the power."""
    size = f"abs({units})"
    drop = f"greatest(0, CAST(floor(log2(greatest({size}, 1))) AS INTEGER) - 59)"
    lead = f"CAST({size} // (CAST(1 AS HUGEINT) << {drop}) AS BIGINT)"
    more = f"CASE WHEN {size} % (CAST(1 AS HUGEINT) << {drop}) <> 0 THEN 1 ELSE 0 END"
    return f"CAST(sign({units}) AS DOUBLE) * CAST({lead} | {more} AS DOUBLE) * pow(2.0, {drop} - 62)"


#: amounts of the test tables over 7 are 0 or at least 2^-9, so all their bits are whole units of 2^-62
_UNITS = "CAST(amount * 4611686018427387904.0 AS HUGEINT)"

_CLIENT_LINES = f"""cl AS (
  SELECT {_clean_sql('text')} AS text, institution, user_id, category, row_id, CAST(amount AS DECIMAL(18,2)) AS amount
  FROM lines
  WHERE row_id IS NOT NULL AND amount IS NOT NULL AND text IS NOT NULL AND category IS NOT NULL
    AND user_id IS NOT NULL)"""

_EXTRACT_SQL = {
    "in": "category IN ('INDEFINIDO', 'click')",
    "greater": "amount > 400.0",
    "between": "category_pct BETWEEN 25.0 AND 50.0",
}

_LINE_COLS = "row_id, text, amount, category, category_pct, ts, user_id, institution"


def _day_part_sql(compat: bool) -> str:
    noite = "n_noite_compat" if compat else "n_noite_fixed"
    return _WITH_GROUPS + f"""
SELECT text, CAST(n_dia AS BIGINT) AS count_dia, CAST(n_tarde AS BIGINT) AS count_tarde,
       CAST({noite} AS BIGINT) AS count_noite, CAST(n_madrugada AS BIGINT) AS count_madrugada
FROM groups"""


def oracle_sql() -> dict[str, str]:
    shares = _profile_sql(False)
    own = {
        "row_count": "SELECT count(*) AS row_count FROM events WHERE event_type <> 'error'",
        "scan_where_limit": """SELECT event_id, user_id, value FROM events
WHERE value > 100 AND event_type IN ('click', 'view')
ORDER BY value DESC, event_id LIMIT 50""",
        "clean_documents": f"SELECT doc_id, {_clean_sql('text')} AS clean FROM documents",
        "percentage_bucket": f"""SELECT event_id, category_pct, {_BUCKET.format(p='category_pct')} AS category_percentual_quartil
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS category_pct FROM events)""",
        "day_part_compat": _day_part_sql(True),
        "day_part_fixed": _day_part_sql(False),
        "totals": _WITH_GROUPS + """
SELECT CAST(sum(cnt) AS BIGINT) AS total_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
       CAST(sum(undefined_count) AS BIGINT) AS undefined_count,
       CAST(sum(undefined_amount) AS DOUBLE) AS undefined_amount,
       CAST(sum(cnt) - sum(undefined_count) AS BIGINT) AS categorised_count,
       CAST(sum(amount) - sum(undefined_amount) AS DOUBLE) AS categorised_amount,
       count(*) AS unique_texts
FROM groups""",
        "text_counts": f"""WITH {_LINES}
SELECT {_clean_sql('text')} AS text, count(*) AS "count", CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lines WHERE row_id IS NOT NULL AND amount IS NOT NULL AND text IS NOT NULL AND category IS NOT NULL
GROUP BY 1""",
        "text_representative": _WITH_GROUPS + "SELECT text, category, quartil AS category_percentual_quartil FROM groups",
        "text_shares": f"""SELECT text, percentual_count, percentual_amount, percentual_dia, percentual_tarde,
       percentual_noite, percentual_madrugada FROM ({shares})""",
        "text_profile_compat": _profile_sql(True),
        "text_profile_fixed": _profile_sql(False),
        "text_ids": f"""WITH {_LINES},
{_PREPARED}
{_id_chunks_sql("prepared WHERE text <> ''", "text", "row_id", "row_ids")}""",
        "document_text_counts": f"""SELECT {_clean_sql('text')} AS text, count(*) AS "count",
       CAST(sum(CAST(CAST(n_chars AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM documents
WHERE doc_id IS NOT NULL AND n_chars IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL
GROUP BY 1""",
        **{f"extract_{k}": f"WITH {_LINES} SELECT {_LINE_COLS} FROM lines WHERE {v}" for k, v in _EXTRACT_SQL.items()},
        "pareto_amount": _pareto_selection_sql("amount"),
        "pareto_count": _pareto_selection_sql("count"),
        "pareto_flags": _flags_sql(),
        "pareto_summary": _RANKED + f"""SELECT r.ranking,
       coalesce(CAST(sum(CAST(p.amount AS DECIMAL(28,2))) AS DOUBLE), 0.0) AS amount,
       count(p.text) FILTER (WHERE p.category <> '{UNDEFINED_CATEGORY}') AS categorised_groups,
       count(p.text) FILTER (WHERE p.category = '{UNDEFINED_CATEGORY}') AS undefined_groups
FROM (VALUES ('amount'), ('count')) r(ranking)
CROSS JOIN sel
LEFT JOIN ranked p ON (CASE WHEN r.ranking = 'amount' THEN p.rank_amount ELSE p.rank_count END) <= sel.n
GROUP BY r.ranking""",
        "client_profile": f"""WITH {_LINES},
{_CLIENT_LINES}
SELECT text, institution, count(*) AS "count", CAST(sum(amount) AS DOUBLE) AS value,
       arg_min(category, row_id) AS category, count(DISTINCT user_id) AS count_clients
FROM cl WHERE text <> '' GROUP BY 1, 2""",
        "text_counts_fractions": f"""WITH {_LINES}
SELECT {_clean_sql('text')} AS text, count(*) AS "count", round(sum(amount / 7), 6) AS amount
FROM lines WHERE row_id IS NOT NULL AND amount IS NOT NULL AND text IS NOT NULL AND category IS NOT NULL
GROUP BY 1""",
        "client_profile_nulls": f"""WITH {_LINES},
{_CLIENT_LINES}
SELECT text, CASE WHEN row_id % 3 <> 0 THEN institution END AS institution, count(*) AS "count",
       CAST(sum(amount) AS DOUBLE) AS value, arg_min(category, row_id) AS category,
       count(DISTINCT user_id) AS count_clients
FROM cl WHERE text <> '' GROUP BY 1, 2""",
        "text_representative_repeated": f"""WITH {_LINES},
{_REPEATED}
SELECT text, row_id AS first_id, category, quartil AS category_percentual_quartil
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY row_id, category, quartil) AS n FROM repeated) WHERE n = 1""",
        "text_ids_repeated": f"""WITH {_LINES},
{_REPEATED}
{_id_chunks_sql("repeated WHERE text <> ''", "text", "row_id", "row_ids", 16)}""",
        "profile_doubles": f"""WITH {_LINES},
{_REPEATED},
sums AS (SELECT text, count(*) AS "count", sum({_UNITS}) AS units FROM repeated GROUP BY text),
whole AS (SELECT {_exact_double('sum(units)')} AS total FROM sums)
SELECT text, "count", {_exact_double('units')} AS amount, {_exact_double('units')} / total AS percentual_amount
FROM sums, whole WHERE text <> ''""",
        "totals_doubles": f"""WITH {_LINES},
{_REPEATED},
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE category = '{UNDEFINED_CATEGORY}') AS u, sum({_UNITS}) AS s,
             coalesce(sum({_UNITS}) FILTER (WHERE category = '{UNDEFINED_CATEGORY}'), 0) AS us, count(DISTINCT text) AS texts FROM repeated)
SELECT n AS total_count, {_exact_double('s')} AS total_amount, u AS undefined_count, {_exact_double('us')} AS undefined_amount,
       n - u AS categorised_count, {_exact_double('(s - us)')} AS categorised_amount, texts AS unique_texts
FROM t""",
        "client_lists_strings": f"""WITH {_LINES},
{_CLIENT_LINES},
ids AS (SELECT DISTINCT text, institution, 'u' || user_id AS u FROM cl WHERE text <> ''),
placed AS (SELECT *, (row_number() OVER (PARTITION BY text, institution ORDER BY u) - 1) // 16 AS chunk FROM ids)
SELECT text, institution, chunk, CAST(0 AS BIGINT) AS part, min(u) AS first_id, max(u) AS last_id, count(*) AS n_ids,
       string_agg(u, '|' ORDER BY u) AS clients
FROM placed GROUP BY text, institution, chunk""",
        "client_lists": f"""WITH {_LINES},
{_CLIENT_LINES}
{_id_chunks_sql("(SELECT DISTINCT text, institution, user_id FROM cl WHERE text <> '')", "text, institution", "user_id", "clients")}""",
        "cleaned_export": f"""SELECT doc_id AS id, max(clean) AS text
FROM (SELECT doc_id, {_clean_sql('text')} AS clean FROM documents WHERE text IS NOT NULL)
WHERE clean <> '' GROUP BY doc_id""",
        "cleaned_export_repeated": f"""SELECT (doc_id // 2) % 300 AS id, max(clean) AS text
FROM (SELECT doc_id, {_clean_sql('text')} AS clean FROM documents WHERE text IS NOT NULL)
WHERE clean <> '' GROUP BY 1""",
        "extract_job": f"WITH {_LINES} SELECT {_LINE_COLS} FROM lines WHERE {_EXTRACT_SQL['between']}",
        "append_roundtrip": f"""WITH {_LINES}
SELECT {_LINE_COLS} FROM lines WHERE {_EXTRACT_SQL['between']}
UNION ALL
SELECT {_LINE_COLS} FROM lines WHERE {_EXTRACT_SQL['between']}""",
        "upsert_roundtrip": _RANKED + f"""SELECT {_PROFILE_COLS},
       CASE WHEN rank_amount <= sel.n THEN 1 END AS pareto_amount
FROM ranked, sel""",
        "keyed_upsert": _flags_sql(),
        "delimited_roundtrip": _profile_sql(False),
        "delimited_documents": "SELECT doc_id, text FROM documents",
        "document_pareto_count": _pareto_selection_sql("count", _WITH_DOC_GROUPS),
        "report_profile": _profile_sql(True),
        "report_ids": f"""WITH {_LINES},
{_PREPARED}
{_id_chunks_sql("prepared WHERE text <> ''", "text", "row_id", "row_ids")}""",
        "stream_text_groups": _WITH_GROUPS + """
SELECT text, CAST(cnt AS BIGINT) AS cnt, CAST(amount AS DOUBLE) AS amount,
       CAST(undefined_count AS BIGINT) AS undefined_count, CAST(undefined_amount AS DOUBLE) AS undefined_amount,
       first_id, category, quartil, CAST(n_madrugada AS BIGINT) AS n_madrugada, CAST(n_dia AS BIGINT) AS n_dia,
       CAST(n_tarde AS BIGINT) AS n_tarde, CAST(n_noite_compat AS BIGINT) AS n_noite_compat,
       CAST(n_noite_fixed AS BIGINT) AS n_noite_fixed
FROM groups""",
    }
    if llm_queries is not None:
        own |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own
