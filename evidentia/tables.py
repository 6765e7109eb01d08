"""Reading the input tables, and the evidence model that queries see in them.

The model's tables are SQL over the input tables, in words that both Spark and other engines read, so that a query and
the SQL that checks it start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import spread

INPUTS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

MODEL = {
    "party": "SELECT n_nationkey AS party_id, n_name AS party_name, n_regionkey AS region_id FROM nation",
    "program": """SELECT n_nationkey AS program_id, n_nationkey AS party_id, DATE '1994-12-01' + n_nationkey * 45 AS published_at,
        DATE '1995-01-01' + n_nationkey * 45 AS period_start,
        CASE WHEN n_nationkey % 5 <> 0 THEN DATE '1999-01-01' + n_nationkey * 45 END AS period_end,
        CASE WHEN n_nationkey = 13 THEN 'rejected' WHEN n_nationkey % 3 = 0 THEN 'reviewed' ELSE 'draft' END AS review FROM nation""",
    "law": """SELECT o_orderkey AS law_id, CAST(o_orderdate AS DATE) AS published_at,
        CASE WHEN o_orderstatus = 'P' THEN 'rejected' ELSE 'draft' END AS review, o_orderpriority AS title FROM orders""",
    "impact": """SELECT l_orderkey * 10000000 + l_partkey AS impact_id, l_orderkey AS law_id, l_partkey AS criterion_id,
        CAST(ROUND(MAX(l_discount) * 100) AS INT) % 5 - 2 AS score, MAX(l_quantity) AS weight,
        CASE WHEN MAX(l_returnflag) = 'A' AND MAX(l_linestatus) = 'F' THEN 'rejected' WHEN MAX(l_returnflag) = 'R' THEN 'reviewed' ELSE 'draft' END AS review,
        CASE WHEN MAX(l_linestatus) = 'O' THEN 'accepted' WHEN MIN(l_tax) = 0 THEN 'missing_context' ELSE 'rejected' END AS evaluation
        FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "criterion": """SELECT p_partkey AS criterion_id, CAST(p_partkey % 25 AS INT) AS program_id, CAST(p_partkey % 25 AS INT) AS party_id, p_name AS title,
        CASE WHEN p_size % 7 = 0 THEN 'rejected' WHEN p_size % 3 = 1 THEN 'reviewed' ELSE 'draft' END AS review,
        CASE WHEN p_size % 5 = 0 THEN 'unassessed' WHEN p_size % 5 = 1 THEN 'partial' WHEN p_size % 5 = 2 THEN 'fulfilled' WHEN p_size % 5 = 3 THEN 'contradicted' ELSE 'mixed' END AS status,
        CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN 1 WHEN p_size % 5 = 2 THEN 2 WHEN p_size % 5 = 3 THEN -2 ELSE 0 END AS assessed_score,
        CASE WHEN p_partkey % 4 < 3 THEN 'agent' ELSE 'editorial' END AS method FROM part""",
    "criterion_tag": """SELECT p_partkey AS criterion_id, p_type AS tag FROM part
        UNION ALL SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey, p_type FROM part WHERE p_size > 25""",
    "evidence": """SELECT criterion_id, MAX(impact_id) AS impact_id FROM impact WHERE evaluation = 'accepted' AND review <> 'rejected' GROUP BY criterion_id
        UNION SELECT criterion_id, MIN(impact_id) FROM impact WHERE weight > 20 GROUP BY criterion_id""",
    "vote": """SELECT l_orderkey * 10 + l_linenumber AS vote_id, l_orderkey AS law_id, CAST(MIN(l_shipdate) AS DATE) - 120 AS vote_date,
        MAX(l_linestatus) = 'O' AS is_public, MAX(l_returnflag) = 'R' AS is_final, MIN(l_quantity) < 48 AS whole_law, MAX(l_suppkey) % 17 <> 0 AS checked,
        CASE WHEN MAX(l_returnflag) = 'R' THEN 'final_passage' WHEN MAX(l_returnflag) = 'N' THEN 'second_reading' ELSE 'amendment' END AS stage
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "vote_coverage": """SELECT o_orderkey AS law_id, CASE WHEN o_totalprice < 30000 THEN 'source_error' WHEN o_totalprice < 60000 THEN 'ambiguous' WHEN o_totalprice < 250000 THEN 'roll_call' ELSE 'group_record' END AS status
        FROM orders WHERE o_totalprice < 400000""",
    "vote_group": """SELECT l_orderkey * 10 + l_linenumber AS vote_id, s_nationkey AS party_id,
        CASE WHEN MIN(l_tax) > 0 THEN CAST(SUM(CASE WHEN l_discount > 0.04 THEN l_quantity ELSE 0 END) AS INT) END AS yes,
        CASE WHEN MIN(l_tax) > 0 THEN CAST(SUM(CASE WHEN l_discount <= 0.02 THEN l_quantity ELSE 0 END) AS INT) END AS no,
        CASE WHEN MIN(l_tax) > 0 THEN CAST(SUM(CASE WHEN l_discount > 0.02 AND l_discount <= 0.03 THEN l_quantity ELSE 0 END) AS INT) END AS abstain,
        CASE WHEN MIN(l_tax) > 0 THEN CAST(SUM(CASE WHEN l_discount > 0.03 AND l_discount <= 0.04 THEN l_quantity ELSE 0 END) AS INT) END AS absent,
        CASE WHEN MIN(l_tax) > 0 THEN NULL WHEN MAX(l_returnflag) = 'R' THEN 'yes' WHEN MAX(l_returnflag) = 'N' THEN 'no' END AS position
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey, l_linenumber, s_nationkey""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def needed(names: list[str]) -> list[str]:
    """The model's tables that these rest on, each after those it reads."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in MODEL:
            if other != name and f" {other} " in f" {' '.join(MODEL[name].split())} ".replace("(", " ").replace(")", " ") and other not in order:
                add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return order


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the evidence model, as a plan over the inputs; no view is registered."""
    ctes = [f"{n} AS ({MODEL[n]})" for n in needed([name])]
    # Line items are many, and are grouped by their order and more everywhere: they are dealt by it, so that tasks don't grow.
    inputs = {n: spread(load(spark, sf_dir, n), "l_orderkey") if n == "lineitem" else load(spark, sf_dir, n) for n in INPUTS if any(f" {n} " in " ".join(MODEL[m].split()) + " " for m in needed([name]))}
    sql = f"WITH {', '.join(ctes)} SELECT * FROM {name}"
    for n in inputs:
        sql = re.sub(rf"(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", sql)
    return spark.sql(sql, **inputs)


def with_model(sql: str, *names: str) -> str:
    """SQL after the model's tables that it needs."""
    own = sql.lstrip()
    rest = f", {own[5:]}" if own.startswith("WITH ") else f" {sql}"
    return f"WITH {', '.join(f'{n} AS ({MODEL[n]})' for n in needed(list(names)))}{rest}"
