"""The core's registered queries and their SQL.  Filled by the modules of ``newsquarry.plans``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsquarry.operators.incremental import due_records
from newsquarry.registry import QUERIES, SQL, query  # noqa: F401
from newsquarry.session import table

_SQL_INSTANT = """CASE WHEN regexp_full_match(trim({0}), '\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?(Z|[+-]\\d{{2}}:\\d{{2}})?')
 THEN CAST(CASE WHEN regexp_matches(trim({0}), '(Z|[+-]\\d{{2}}:\\d{{2}})$') THEN trim({0}) ELSE trim({0}) || 'Z' END AS TIMESTAMPTZ) END"""


@query(
    "p2_found",
    f"""WITH log AS (SELECT state_key, {_SQL_INSTANT.format('value')} AS mark, {_SQL_INSTANT.format('updated_at')} AS written FROM export_state),
ranked AS (SELECT state_key, mark, row_number() OVER (PARTITION BY state_key ORDER BY mark IS NULL, written DESC, mark DESC) AS n FROM log),
marks AS (SELECT state_key, mark FROM ranked WHERE n = 1),
rows_ AS (SELECT article_id, {_SQL_INSTANT.format('fetched_at')} AS f, {_SQL_INSTANT.format('matched_at')} AS m FROM articles)
SELECT DISTINCT state_key, article_id FROM rows_ JOIN marks ON mark IS NULL OR f >= mark OR m >= mark""",
)
def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return due_records(table(spark, root, "articles"), table(spark, root, "export_state"), "article_id", ["fetched_at", "matched_at"])


from newsquarry.plans import registered, workflow  # noqa: E402, F401  the modules that fill the tables above
