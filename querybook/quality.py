"""Checks as reports, and tallies of a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindsight.operators import checks as q
from hindsight.operators import profile, sketches
from hindsight.plans import reports
from hindsight.session import null_safe, shared_dir, stage
from hindsight.sources.tables import VersionedTable
from querybook.base import Book, table
from querybook.layers import games
from querybook.standins import GAMES_SQL

book = Book()


@book.add(
    "SELECT CASE WHEN n = 0 THEN true ELSE false END AS ok, n || ' orphan rows' AS detail, 'documents labelled' AS name "
    "FROM (SELECT count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))"
)
def orphans(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    return q.check_orphans(documents, labels, "documents labelled", ["doc_id"])


@book.add(
    "SELECT o_custkey AS custkey, true AS only_left FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 5 <> 0) "
    "WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0) UNION ALL "
    "SELECT c_custkey, false FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey NOT IN "
    "(SELECT o_custkey FROM orders WHERE o_custkey % 5 <> 0)"
)
def reconcile_keys(spark, sf_dir):
    """Which keys are on one side only, of two sides that differ on purpose."""
    left = table(spark, sf_dir, "orders").selectExpr("o_custkey custkey").where("custkey % 5 <> 0")
    right = table(spark, sf_dir, "customer").selectExpr("c_custkey custkey").where("custkey % 7 <> 0")
    return q.reconcile_keys(left, right, ["custkey"])


@book.add("""
SELECT unnest([
 {'name': 'status domain', 'ok': s = 0, 'detail': s || ' bad rows, at most 0'},
 {'name': 'price known', 'ok': true, 'detail': '0 bad rows, at most 0'},
 {'name': 'rows', 'ok': n >= 1000, 'detail': n || ' rows, at least 1000'},
 {'name': 'finished rows', 'ok': f >= 1000000, 'detail': f || ' rows, at least 1000000'},
 {'name': 'one status', 'ok': true, 'detail': '0 bad rows, at most 0'},
 {'name': 'first order has no price class', 'ok': z = 0, 'detail': z || ' values of o_custkey with more than 1 bad rows'}
], recursive := true) FROM (
 SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS s, count(*) FILTER (o_orderstatus = 'F') AS f,
        (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) FILTER (o_totalprice < 5000) > 1)) AS z
 FROM orders)
""")
def row_rules(spark, sf_dir):
    """Every rule kind over orders; some customers have two cheap orders, others none."""
    flags = {f"is_{s}": (F.col("o_orderstatus") == s).cast("int") for s in ("F", "O", "P")}
    orders = table(spark, sf_dir, "orders").withColumns(
        {**flags, "price_class": F.expr("if(o_totalprice < 5000, null, cast(o_totalprice / 1000 as int))")}
    )
    rules = [
        q.in_domain("status domain", "o_orderstatus", ["F", "O"]),
        q.not_null_where("price known", "o_totalprice", F.col("o_orderstatus") == "F"),
        q.Floor("rows", 1_000),
        q.Floor("finished rows", 1_000_000, F.col("o_orderstatus") == "F"),
        q.one_hot_sum("one status", list(flags)),
        q.null_bound("first order has no price class", "price_class", per="o_custkey"),
    ]
    return q.check_rows(orders, rules)


@book.add(
    "SELECT count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH') IS NOT TRUE) AS outside FROM orders"
)
def domain_check(spark, sf_dir):
    rule = q.in_domain("priority", "o_orderpriority", ["1-URGENT", "2-HIGH"])
    orders = table(spark, sf_dir, "orders")
    return orders.agg(F.count_if(~F.coalesce(rule.holds, F.lit(False))).alias("outside"))


@book.add("SELECT o_orderstatus, o_orderpriority, count(*) AS total FROM orders GROUP BY ALL")
def crosstab(spark, sf_dir):
    return profile.tally(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], {})


@book.add(
    "SELECT event_type, count(*) AS total, count(*) FILTER (value > 100) AS large, count(*) FILTER (user_id % 2 = 0) "
    "AS even FROM events GROUP BY ROLLUP (event_type)"
)
def grand_totals(spark, sf_dir):
    counters = {"large": F.col("value") > 100, "even": F.col("user_id") % 2 == 0}
    return profile.tally(table(spark, sf_dir, "events"), ["event_type"], counters, total=True)


@book.add("""
WITH c AS (SELECT user_id, event_type, coalesce(nullif(CAST(event_id % 9 AS VARCHAR), '8'), '?') AS kind FROM events),
u AS (SELECT user_id, 'event_type' AS dimension, event_type AS value, count(*) AS rows FROM c GROUP BY ALL
      UNION ALL SELECT user_id, 'kind', kind, count(*) FROM c GROUP BY ALL)
SELECT user_id, dimension, value, rows, row_number() OVER (PARTITION BY user_id, dimension ORDER BY rows DESC, value)
  AS rank FROM u QUALIFY rank <= 3
""")
def top_values(spark, sf_dir):
    """The three most frequent values of two dimensions per user; null counts as '?'."""
    events = table(spark, sf_dir, "events").selectExpr(
        "user_id", "event_type", "nullif(cast(event_id % 9 as string), '8') kind"
    )
    counts = profile.value_counts(events, ["user_id"], ["event_type", "kind"])
    return profile.top_values(counts, ["user_id", "dimension"], 3)


@book.add("SELECT p_brand AS value, count(*) AS rows FROM part GROUP BY ALL ORDER BY rows DESC, value LIMIT 6")
def top_k(spark, sf_dir):
    counts = profile.value_counts(table(spark, sf_dir, "part"), [], ["p_brand"])
    return profile.top_overall(counts, 6).select("value", "rows")


@book.add(f"""
WITH {GAMES_SQL} SELECT account, count(*) AS total, count(*) FILTER (rated) AS rated,
  count(*) FILTER (NOT rated) AS unrated, count(*) FILTER (rated AND time_class = 'rapid') AS rated_rapid,
  count(*) FILTER (rated AND time_class = 'blitz') AS rated_blitz, count(*) FILTER (is_friend) AS friend,
  count(*) FILTER (is_friend AND rated) AS friend_rated, count(*) FILTER (is_friend AND NOT rated) AS friend_unrated,
  count(*) FILTER (rules <> 'chess') AS variants FROM games GROUP BY ROLLUP (account)
""")
def profile_source(spark, sf_dir):
    return reports.profile_games(games(spark, sf_dir))


@book.add(f"""
WITH {GAMES_SQL}, u AS (
  SELECT account, unnest(['time_class', 'rules', 'time_control']) AS dimension,
         unnest([time_class, rules, time_control]) AS value FROM games),
c AS (SELECT account, dimension, value, count(*) AS rows FROM u GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY account, dimension ORDER BY rows DESC, value) AS rank FROM c QUALIFY rank <= 6
""")
def profile_dimensions(spark, sf_dir):
    return reports.top_dimensions(games(spark, sf_dir))


@book.add(
    f"WITH {GAMES_SQL} SELECT count(*) AS total, count(*) - 3500 AS margin, count(*) >= 3500 AS ok FROM games"
)
def claim_verdict(spark, sf_dir):
    return reports.claim_verdict(games(spark, sf_dir), 3_500)


COMPARE_SQL = """
s AS (SELECT count(*) FILTER (g) AS n_in, count(*) FILTER (g AND hit) AS hits_in, count(*) FILTER (NOT g) AS n_out,
             count(*) FILTER (NOT g AND hit) AS hits_out FROM d),
p AS (SELECT *, hits_in / n_in AS p, hits_out / n_out AS q, (hits_in + hits_out) / (n_in + n_out) AS r FROM s),
e AS (SELECT *, sqrt(q * (1 - q) / n_out) AS e FROM p)
SELECT n_in, hits_in, n_out, hits_out, round(p, 6) AS rate_in, round(q, 6) AS rate_out,
  round((p - q) / sqrt(r * (1 - r) * (1.0::DOUBLE / n_in + 1.0::DOUBLE / n_out)), 6) AS z_score,
  round(q - 1.96::DOUBLE * e, 6) AS low, round(q + 1.96::DOUBLE * e, 6) AS high,
  p >= q - 1.96::DOUBLE * e AND p <= q + 1.96::DOUBLE * e AS within_range FROM e
"""


@book.add(f"WITH d AS (SELECT user_id % 10 = 0 AS g, event_type = 'purchase' AS hit FROM events), {COMPARE_SQL}")
def rate_compare(spark, sf_dir):
    return profile.compare_rates(
        table(spark, sf_dir, "events"), F.col("user_id") % 10 == 0, F.col("event_type") == "purchase"
    )


@book.add(f"WITH {GAMES_SQL}, d AS (SELECT is_friend AS g, result = 'won' AS hit FROM games), {COMPARE_SQL}")
def friends_against_others(spark, sf_dir):
    return reports.friends_against_others(games(spark, sf_dir))


@book.add(f"WITH {GAMES_SQL}, d AS (SELECT account_code = 0 AS g, result = 'won' AS hit FROM games), {COMPARE_SQL}")
def accounts_compared(spark, sf_dir):
    return reports.accounts_compared(games(spark, sf_dir))


RATES_SQL = (
    "count(*) AS n, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 6) AS rate, "
    "round(sqrt((count(*) FILTER (hit) / count(*)) * (1 - count(*) FILTER (hit) / count(*)) / count(*)), 6) AS std_error"
)


@book.add(
    f"WITH {GAMES_SQL}, d AS (SELECT hour((coalesce(start_ts, make_timestamp(end_sec * 1000000)) AT TIME ZONE 'UTC') "
    f"AT TIME ZONE 'America/New_York')::INT AS local_hour, result = 'won' AS hit FROM games) "
    f"SELECT local_hour, {RATES_SQL} FROM d GROUP BY local_hour"
)
def rate_by_local_hour(spark, sf_dir):
    return reports.win_rate_by_local_hour(games(spark, sf_dir))


@book.add(f"""
WITH {GAMES_SQL}, w AS (SELECT result = 'won' AS hit, lag(result, 1) OVER line AS l1, lag(result, 2) OVER line AS l2
  FROM games WINDOW line AS (PARTITION BY person_id ORDER BY activity_sec, game_uuid, account)),
d AS (SELECT hit, CASE WHEN l1 = 'lost' AND l2 = 'lost' THEN 2 WHEN l1 = 'lost' THEN 1 ELSE 0 END AS losses_before FROM w)
SELECT losses_before, {RATES_SQL} FROM d GROUP BY losses_before
""")
def rate_after_losses(spark, sf_dir):
    # written, as the timeline's slices read their rows twice
    return reports.win_rate_after_losses(stage(games(spark, sf_dir), "games"))


WIDE = ["o_orderkey", "o_custkey"]


@book.add("""
WITH o AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, date_trunc('year', o_orderdate)::DATE AS year, * FROM orders),
g AS (SELECT 'month' AS grain, month AS period, count(*) AS rows, count(DISTINCT o_orderkey) AS a, count(DISTINCT o_custkey) AS b FROM o GROUP BY month
 UNION ALL SELECT 'year', year, count(*), count(DISTINCT o_orderkey), count(DISTINCT o_custkey) FROM o GROUP BY year
 UNION ALL SELECT 'all', NULL, count(*), count(DISTINCT o_orderkey), count(DISTINCT o_custkey) FROM o)
SELECT grain, period, 'o_orderkey' AS "column", rows AS known, a AS exact, true AS within, true AS same FROM g
UNION ALL SELECT grain, period, 'o_custkey', rows, b, true, true FROM g
""")
def merged_distinct(spark, sf_dir):
    """Distinct orders and customers a month, a year and in all, from sketches stored by month.

    The months up to 1995 are stored first, a part of December too early to be whole; the second run
    brings the later ones and December anew. ``within``: the exact count is in the stated range.
    ``same``: the merged sketch says what one over all rows of the period says.
    """
    orders = table(spark, sf_dir, "orders").select(*WIDE, "o_orderdate").withColumns(
        {g: F.trunc("o_orderdate", g).cast("date") for g in ("month", "year")}
    ).withColumn("all", F.lit(None).cast("date"))
    store = VersionedTable(spark, shared_dir(spark, "sketches"))
    early = F.col("o_orderdate") < F.lit("1995-12-20").cast("timestamp")
    sketches.refreshed(store, orders.where(early), ["month"], WIDE)
    sketches.refreshed(store, orders.where("month >= date '1995-12-01'"), ["month"], WIDE)
    stored = store.read().withColumns({"year": F.trunc("month", "year").cast("date"), "all": F.lit(None).cast("date")})

    out = None
    for grain in ("month", "year", "all"):
        counts = sketches.distinct_values(sketches.merged(stored, [grain], WIDE), [grain], WIDE)
        once = sketches.merged(sketches.sketched(orders, [grain], WIDE), [grain], WIDE)
        once = sketches.distinct_values(once, [grain], WIDE).select(F.col(grain).alias("of"), F.col("column").alias("name"), F.col("estimate").alias("once"))
        pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("name_"), F.col(c).alias("value")) for c in WIDE]))
        exact = orders.select(F.col(grain).alias("of_"), pairs).groupBy("of_", "name_").agg(F.countDistinct("value").alias("exact"))
        both = counts.join(once, null_safe(counts, once, [grain, "column"], ["of", "name"]))
        both = both.join(exact, null_safe(both, exact, [grain, "column"], ["of_", "name_"]))
        rows = both.select(
            F.lit(grain).alias("grain"),
            F.col(grain).alias("period"),
            "column",
            "known",
            "exact",
            F.col("exact").between(F.col("low"), F.col("high")).alias("within"),
            (F.col("estimate") == F.col("once")).alias("same"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@book.add("""
WITH w AS (SELECT lang, unnest(string_split(text, ' ')) AS value FROM documents),
n AS (SELECT lang, count(value) AS known FROM w GROUP BY lang)
SELECT w.lang, value, count(*) AS rows, known FROM w JOIN n ON w.lang IS NOT DISTINCT FROM n.lang
GROUP BY w.lang, value, known HAVING count(*) * 500 >= known
""")
def heavy_words(spark, sf_dir):
    """Words that make up at least one in 500 of a language's, from sketches stored by language and source."""
    words = table(spark, sf_dir, "documents").select("lang", "source", F.explode(F.split("text", " ")).alias("word"))
    stored = stage(sketches.sketched(words, ["lang", "source"], ["word"]), "sketches")
    return sketches.heavy_values(words, sketches.merged(stored, ["lang"], ["word"]), ["lang"], "word", one_in=500)
