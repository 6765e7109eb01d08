"""Plenary protocols: chairs' blocks, decisions and the sides of groups, in texts that Spark makes from the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import spread
from ..sources import transcripts as P
from ..tables import load
from .registry import query
from .text_queries import WS

NAMES = {"spd": "SPD", "afd": "AfD", "linke": "Die Linke"}
SIDES = ["yes", "no", "abstain"]
SIDE_OF = {party: f"(o_orderkey // {3**k}) % 3" for k, party in enumerate(NAMES)}


@query("WITH side AS (" + " UNION ALL ".join(f"SELECT o_orderkey AS k, '{p}' AS party_id, ['yes', 'no', 'abstain'][1 + {of}] AS side FROM orders" for p, of in SIDE_OF.items()) + """
    UNION SELECT o_orderkey, 'afd', 'no' FROM orders WHERE o_orderkey % 11 = 0), plain AS (SELECT *, side = 'yes' AND k % 7 = 0 AS qualified FROM side),
  g AS (SELECT k, party_id, list(DISTINCT side) FILTER (NOT qualified) AS sides, bool_or(qualified) AS qualified FROM plain GROUP BY ALL), t AS (SELECT *, max(coalesce(len(sides), 0)) OVER (PARTITION BY k) AS most FROM g)
  SELECT k AS quote_id, party_id, sides[1] AS position FROM t WHERE most = 1 AND len(sides) = 1 AND NOT qualified""")
def protocol_positions(spark, sf_dir):
    """WIN-13, DOM-06, DOM-08: sides of three groups in a chair's words, one quote an order; some qualified, some contradicted."""
    k = F.col("o_orderkey")
    by_side = {side: [F.when(F.expr(f"(o_orderkey div {3**i}) % 3") == n, F.lit(name)) for i, name in enumerate(NAMES.values())] for n, side in enumerate(SIDES)}
    by_side["no"].append(F.when((k % 11 == 0) & (F.expr("(o_orderkey div 3) % 3") != 1), F.lit("AfD")))
    said = {side: F.array_join(F.array_compact(F.array(*names)), " und ") for side, names in by_side.items()}
    some = F.when(k % 7 == 0, F.lit("Einige Abgeordnete der ")).otherwise(F.lit(""))
    text = F.concat(
        F.lit("Ich bitte diejenigen, die dem zustimmen, um das Handzeichen. – "), some, said["yes"], F.lit(". Gegenprobe! – "), said["no"], F.lit(". Enthaltungen? – "), said["abstain"], F.lit(". Damit ist der Gesetzentwurf angenommen.")
    )
    quotes = load(spark, sf_dir, "orders").select(k.alias("quote_id"), text.alias("text"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("comments"))
    return P.group_positions(quotes)


# A document's number has at most six digits (T.document_numbers). An order's whole key is named: digits beyond six in a second number.
HIGH = "CAST(floor(k / 1000000) AS BIGINT)"
BLOCK = f"""'Der Ausschuss empfiehlt, den Gesetzentwurf auf Drucksache 20/' || (k % 1000000) || CASE WHEN k >= 1000000 THEN ' und 21/' || {HIGH} ELSE '' END || ' anzunehmen. Zweite und dritte Beratung. Ich bitte diejenigen, die dem zustimmen, um das Handzeichen. Der Gesetzentwurf ist in zweiter Beratung angenommen. ' ||
    CASE WHEN k % 5 = 0 THEN 'Zusatzpunkt 4. ' ELSE '' END || 'Wir kommen zur Schlussabstimmung. Ich bitte diejenigen, die zustimmen wollen, sich zu erheben. Der Gesetzentwurf ist ' || CASE WHEN k % 4 = 0 THEN 'abgelehnt' ELSE 'angenommen' END || '.'"""


@query(f"""WITH b AS (SELECT k, {BLOCK} AS t FROM (SELECT o_orderkey AS k FROM orders)), e AS (SELECT k, t, CASE WHEN k % 2 = 0 THEN strpos(t, 'Schlussabstimmung') - 1 ELSE strpos(t, 'Ich bitte') - 1 END AS a, CASE WHEN k % 2 = 0 THEN length(t) ELSE strpos(t, 'Beratung angenommen.') + 19 END AS z FROM b)
  SELECT k AS block_id, a AS start, z AS stop, substr(t, a::INT + 1, (z - a)::INT) AS quote FROM e WHERE k % 3 <> 0 AND NOT (k % 2 = 0 AND k % 5 = 0)""")
def protocol_decisions(spark, sf_dir):
    """DOM-07, DOM-09, WIN-13: passages of the final vote or second reading on a number; other items break the reference."""
    k = F.col("o_orderkey")
    orders = spread(load(spark, sf_dir, "orders").select(k.alias("k")), "k")  # few bytes, but long work on each
    text = F.expr(BLOCK)
    asked = F.when(F.col("k") % 3 == 0, F.col("k") + 1).otherwise(F.col("k"))
    numbers = F.array_compact(F.array(F.concat(F.lit("20/"), asked % 1_000_000), F.when(F.col("k") >= 1_000_000, F.concat(F.lit("21/"), F.expr(HIGH)))))
    blocks = orders.select(F.col("k").alias("block_id"), text.alias("text"), numbers.alias("numbers"), F.when(F.col("k") % 2 == 0, "final_passage").otherwise("second_reading").alias("stage"))
    return P.decision_passages(blocks).select("block_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("stop"), "quote")


@query(f"""WITH t AS (SELECT conv_id, turn, role = 'assistant' AS speech, {WS.format(c='text')} AS text FROM conversations), r AS (SELECT *, count(*) FILTER (speech) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM t),
  b AS (SELECT conv_id AS sitting_id, run, min(turn) AS first, string_agg(text, chr(10) ORDER BY turn) AS text FROM r WHERE NOT speech GROUP BY ALL)
  SELECT sitting_id, row_number() OVER (PARTITION BY sitting_id ORDER BY first) - 1 AS block, text FROM b""")
def protocol_blocks(spark, sf_dir):
    """SRC-10, SRC-11: what a chair says between speeches, in XML made of conversations: users' turns as paragraphs, others as speeches."""
    text = F.coalesce(T.collapsed(F.col("text")), F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    turn = F.when(F.col("role") == "assistant", F.concat(F.lit("<rede><p>"), text, F.lit("</p></rede>"))).otherwise(F.concat(F.lit("<p>"), text, F.lit("</p>")))
    turns = load(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", turn.alias("xml")).alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    body = F.array_join(F.transform("turns", lambda t: t["xml"]), "")
    whole = F.concat(F.lit('<dbtplenarprotokoll><sitzungsverlauf><tagesordnungspunkt top-id="T1">'), body, F.lit("</tagesordnungspunkt></sitzungsverlauf></dbtplenarprotokoll>"))
    blocks = P.chair_blocks(turns.select(F.col("conv_id").alias("sitting_id"), whole.alias("xml"))).where("problem is null")
    return blocks.select("sitting_id", F.col("block").cast("long").alias("block"), "text")
