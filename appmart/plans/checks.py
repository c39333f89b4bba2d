"""The declared keys of the modelled tables, checked (G12, G13 inside the pipeline).

The constraints are declared and not enforced; a run records how many keys
break each one.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appmart import functions as fn
from appmart.operators import fk_orphans, pk_duplicates
from appmart.plans import dims, facts, marts

# --- Fixed values: the declared constraints (table, column[, referenced dimension]).
PRIMARY_KEYS = [(dims.APP_USER_DIM, "hash_key"), (dims.CAMPAIGN_DIM, "hash_key")]
FOREIGN_KEYS = [
    (facts.ENGAGEMENT, "hash_key", dims.APP_USER_DIM),
    (facts.RATING, "hash_key", dims.APP_USER_DIM),
    (marts.MERGED, "hash_key", dims.APP_USER_DIM),
    (marts.MERGED, "hash_date_campaign_country", dims.CAMPAIGN_DIM),
    (facts.SPEND, "hash_key", dims.CAMPAIGN_DIM),
    (facts.INSTALLS, "hash_key", dims.APP_USER_DIM),
    (facts.INSTALLS, "hash_date_campaign_country", dims.CAMPAIGN_DIM),
    (facts.TRIALS, "hash_key", dims.APP_USER_DIM),
]


def key_checks(tables: Mapping[str, DataFrame], etl_ts: str, dag_execution_date: str | None) -> DataFrame:
    """One row per declared constraint: repeated primary keys, or rows whose foreign key is missing."""
    date = fn.ts_literal(dag_execution_date) if dag_execution_date else F.lit(None).cast("timestamp")

    def row(found: DataFrame, kind: str, table: str, column: str, reference: str | None) -> DataFrame:
        return found.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_type"), F.lit(column).alias("column_name"),
            F.lit(reference).cast("string").alias("reference_table"), date.alias("dag_execution_date"),
            fn.ts_literal(etl_ts).alias("etl_timestamp"), "violations")

    rows = [row(pk_duplicates(tables[t].select(c), c), "PRIMARY KEY", t, c, None) for t, c in PRIMARY_KEYS]
    rows += [row(fk_orphans(tables[t].select(c), tables[d], c), "FOREIGN KEY", t, c, d) for t, c, d in FOREIGN_KEYS]
    return reduce(DataFrame.unionByName, rows)
