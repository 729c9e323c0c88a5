"""Registered queries of entity resolution, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.functions.names import birth_token, folded_name
from touchline.operators import resolution, similarity
from touchline.operators.graph import connected_components
from touchline.plans.base import query
from touchline.sources.shared import staged, table


def _cosines(left: str, right: str, floor: float, top: int, others_only: bool = False) -> str:
    """SQL that compares all pairs: ``left`` and ``right`` give (id, name)."""
    return f"""
    WITH a AS ({left}), b AS ({right}), n AS (SELECT name FROM a UNION ALL SELECT name FROM b),
    g AS (SELECT name, unnest(list_transform(range(1, greatest(length(replace(name, ' ', '')) - 1, 1)), lambda i: substr(replace(name, ' ', ''), i, 3))) AS g, m FROM (SELECT name, count(*) AS m FROM n GROUP BY 1)),
    t AS (SELECT name, m, g, count(*) AS tf FROM g GROUP BY 1, 2, 3), d AS (SELECT g, sum(m)::DOUBLE AS df FROM t GROUP BY 1),
    w AS (SELECT name, g, tf * (ln((1 + (SELECT count(*) FROM n))::DOUBLE / (1 + df)) + 1) AS w FROM t JOIN d USING (g)),
    u AS (SELECT name, g, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w FROM w),
    p AS (SELECT x.name AS na, y.name AS nb, round(sum(x.w * y.w), 9) AS score FROM u x JOIN u y USING (g) WHERE x.name IN (SELECT name FROM a) AND y.name IN (SELECT name FROM b) GROUP BY 1, 2 HAVING round(sum(x.w * y.w), 9) >= {floor}),
    r AS (SELECT a.id AS id_a, b.id AS id_b, score, row_number() OVER (PARTITION BY a.id ORDER BY score DESC, b.id)::INTEGER AS rank FROM p JOIN a ON a.name = na JOIN b ON b.name = nb {"WHERE a.id <> b.id" if others_only else ""})
    SELECT id_a, id_b, round(score, 6) AS score, rank FROM r WHERE rank <= {top}
    """


def _similar(a, b, **how):
    return similarity.similar_names(a, b, staged, **how).withColumn("score", F.round("score", 6))


@query(_cosines("SELECT c_custkey AS id, c_name AS name FROM customer", "SELECT s_suppkey AS id, s_name AS name FROM supplier", 0.4, 5))
def j25_similar_names(spark, d):
    """Customers and the suppliers with the most similar names: top 5, cosine of trigram weights of 0.4 or more."""
    customers, suppliers = table(spark, d, "customer"), table(spark, d, "supplier")
    return _similar(customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), suppliers.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), floor=0.4, top=5)


@query(_cosines("SELECT c_custkey AS id, c_name AS name FROM customer", "SELECT c_custkey AS id, c_name AS name FROM customer", 0.3, 5, True))
def j25_similar_customers(spark, d):
    """Customers among themselves: each one's five most similar others, 0.3 or more."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return _similar(rows, rows, floor=0.3, top=5, others_only=True)


@query(_cosines("SELECT p_partkey AS id, p_name || ' ' || p_type AS name FROM part", "SELECT p_partkey AS id, p_name || ' ' || p_type AS name FROM part", 0.25, 5, True))
def j25_similar_parts(spark, d):
    """Parts, whose names repeat in large groups: each one's five most similar others, 0.25 or more."""
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    return _similar(rows, rows, floor=0.25, top=5, others_only=True)


@query("""
    WITH RECURSIVE a AS (SELECT s_suppkey AS id, s_name AS name FROM supplier), b AS (SELECT c_custkey AS id, c_name AS name FROM customer),
    l AS (SELECT a.id AS ia, b.id AS ib, a.name AS na, string_split(b.name, '') AS nb, 0 AS i, list_transform(range(0, length(b.name)), lambda x: 0::BIGINT) AS row FROM a, b
        UNION ALL SELECT ia, ib, na, nb, i + 1, list_transform(range(1, len(nb) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN nb[k] = substr(na, i + 1, 1) THEN coalesce(row[k - 1], 0) + 1 ELSE row[k] END))) FROM l WHERE i < length(na)),
    s AS (SELECT ia, ib, round(200.0::DOUBLE * row[len(nb)] / (length(na) + len(nb)), 9) AS score FROM l WHERE i = length(na)),
    r AS (SELECT *, row_number() OVER (PARTITION BY ia ORDER BY score DESC, ib) AS k FROM s WHERE score >= 50),
    e AS (SELECT ia, max(CASE WHEN k = 1 THEN ib END) AS ib, max(CASE WHEN k = 1 THEN score END) AS score, max(CASE WHEN k = 2 THEN score END) AS second FROM r WHERE k <= 2 GROUP BY 1 HAVING max(score) >= 70),
    c AS (SELECT *, row_number() OVER (PARTITION BY ib ORDER BY score DESC, ia) AS k, lead(score) OVER (PARTITION BY ib ORDER BY score DESC, ia) AS lost FROM e)
    SELECT ia AS id_a, ib AS id_b, round(score, 6) AS score, round(greatest(second, lost), 6) AS runner_up FROM c WHERE k = 1
""")
def j26_fuzzy_names(spark, d):
    """Suppliers and customers one to one by the token-sort ratio, 70 or more, with the best other claim."""
    suppliers, customers = table(spark, d, "supplier"), table(spark, d, "customer")
    out = similarity.best_names(suppliers.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), staged)
    return out.withColumn("score", F.round("score", 6)).withColumn("runner_up", F.round("runner_up", 6))


@query(r"""
    WITH f AS (SELECT doc_id, replace(replace(replace(lower(coalesce(text, '')), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe') AS t FROM documents)
    SELECT doc_id, md5(trim(regexp_replace(regexp_replace(strip_accents(t), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS folded FROM f
""")
def f18_folded_texts(spark, d):
    """Whole texts folded as names are: lower case, no accents, no punctuation."""
    return table(spark, d, "documents").select("doc_id", F.md5(folded_name(F.col("text"))).alias("folded"))


@query("""
    SELECT o_orderkey, strftime(o_orderdate::DATE, '%d') || substr('ABCDEFGHIJKL', month(o_orderdate::DATE)::INTEGER, 1) || strftime(o_orderdate::DATE, '%y') AS token FROM orders
""")
def f18_birth_tokens(spark, d):
    return table(spark, d, "orders").select("o_orderkey", birth_token(F.col("o_orderdate").cast("date").cast("string")).alias("token"))


def _people(rows, key, name, team, place, shift):
    """Rows of a table as records: birth dates follow from the keys, and those of one source are recorded with slips."""
    born = F.date_add(F.lit("1980-01-01").cast("date"), ((F.col(key) * 97) % 7000).cast("int"))
    text = F.date_format(born, "yyyy-MM-dd")
    slip = F.when(F.col(key) % 5 == 1, F.date_format(F.date_add(born, 1), "yyyy-MM-dd")).when(F.col(key) % 5 == 2, F.date_format(born, "yyyy-dd-MM")).when(F.col(key) % 5 == 3, F.lit(None).cast("string")).otherwise(text)
    return rows.select(F.col(key).alias("id"), F.col(name).alias("name"), (slip if shift else text).alias("birth_date"), place.alias("position"), F.col(team).cast("string").alias("team"), (F.col(key) % 40).cast("string").alias("number"))


def resolved_people(spark, d):
    place = lambda c: F.element_at(F.array(*map(F.lit, ("Goalkeeper", "Left Back", "Center Midfield", "Striker"))), (F.col(c) % 4 + 1).cast("int"))
    a = _people(table(spark, d, "supplier"), "s_suppkey", "s_name", "s_nationkey", place("s_suppkey"), False)
    b = _people(table(spark, d, "customer"), "c_custkey", "c_name", "c_nationkey", place("c_custkey"), True)
    return a, b


@query(None)
def d25_resolved_layers(spark, d):
    """Suppliers and customers as records of two sources: three layers, each with the rows that are left."""
    return resolution.resolve_layers(*resolved_people(spark, d), staged)


def _candidates(spark, d):
    """Suppliers with the customers of their nation as candidates, scores from the account balances."""
    s, c = table(spark, d, "supplier"), table(spark, d, "customer")
    near = c.where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("id_b"), F.col("c_nationkey").alias("n"), F.round(F.col("c_acctbal") / 100, 2).alias("score"), F.lead(F.round(F.col("c_acctbal") / 100, 2)).over(Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), "c_custkey")).alias("runner_up"))
    own = s.groupBy(F.col("s_nationkey").alias("n")).agg(F.min("s_suppkey").cast("string").alias("id_a"))
    return near.join(own, "n").select(F.lit("supplier").alias("source_a"), "id_a", F.lit("customer").alias("source_b"), "id_b", "score", "runner_up")


def _decisions(spark, d):
    """Hand decisions from orders: urgent orders link the customer with the supplier of its number, low ones part them; dates decide."""
    o = table(spark, d, "orders").where("o_orderpriority in ('1-URGENT', '5-LOW')")
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n")).agg(F.min("s_suppkey").cast("string").alias("id_b"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n"))
    rows = o.join(c, "o_custkey").join(s, "n")
    return rows.select(F.lit("customer").alias("source_a"), F.col("o_custkey").cast("string").alias("id_a"), F.lit("supplier").alias("source_b"), "id_b", F.when(F.col("o_orderpriority") == "1-URGENT", "must").otherwise("cannot").alias("verdict"), (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1_000_000 + F.col("o_orderkey")).alias("decided_at"))


BANDED = """
    m AS (SELECT s_nationkey AS n, min(s_suppkey)::VARCHAR AS s FROM supplier GROUP BY 1),
    c AS (SELECT 'customer' AS source_a, c_custkey::VARCHAR AS id_a, 'supplier' AS source_b, m.s AS id_b, round(c_acctbal / 100, 2) AS score,
        lead(round(c_acctbal / 100, 2)) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS runner_up FROM customer JOIN m ON c_nationkey = m.n WHERE c_acctbal > 0),
    v AS (SELECT o_custkey::VARCHAR AS id_a, m.s AS id_b, arg_max(CASE o_orderpriority WHEN '1-URGENT' THEN 'must' ELSE 'cannot' END, epoch(o_orderdate::TIMESTAMP)::BIGINT * 1000000 + o_orderkey) AS verdict
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN m ON c_nationkey = m.n WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1, 2),
    h AS (SELECT id_b, min(id_a) AS low, max(id_a) AS high FROM v WHERE verdict = 'must' GROUP BY 1),
    j AS (SELECT coalesce(c.id_a, v.id_a) AS id_a, coalesce(c.id_b, v.id_b) AS id_b, coalesce(c.score, 100) AS score, coalesce(runner_up, 0) AS rival, verdict, c.id_a IS NULL AS only_decided
        FROM c FULL JOIN v ON c.id_a = v.id_a AND c.id_b = v.id_b),
    b AS (SELECT 'customer' AS source_a, j.id_a, 'supplier' AS source_b, j.id_b, score, rival,
        CASE WHEN verdict = 'must' THEN 'hand' WHEN verdict = 'cannot' THEN 'blocked' WHEN h.low <> j.id_a OR h.high <> j.id_a THEN 'shadowed' WHEN score >= 80 THEN 'auto' WHEN score <= 20 THEN 'reject' ELSE 'queue' END AS state
        FROM j LEFT JOIN h ON j.id_b = h.id_b WHERE NOT only_decided OR verdict = 'must')
"""


@query(f"WITH {BANDED} SELECT source_a, id_a, source_b, id_b, score, state, state = 'queue' AND score - rival >= 0.5 AND score > rival AS recommended FROM b")
def d26_bands(spark, d):
    """Candidates after hand decisions and bands: the latest decision counts, records linked by hand shadow other candidates."""
    return resolution.banded(_candidates(spark, d), _decisions(spark, d), auto_min=80.0, reject_max=20.0, margin=0.5)


@query(None)
def d26_constrained_clusters(spark, d):
    """Regions, suppliers, customers and parts that share a number: clusters with one record of each source."""
    keys = {"supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey"}
    rows = {s: table(spark, d, s) for s in keys}
    records = None
    for s, k in keys.items():
        own = rows[s].select(F.lit(s).alias("source"), F.lpad(F.col(k).cast("string"), 9, "0").alias("id"))
        records = own if records is None else records.unionByName(own)
    most = {s: rows[s].count() for s in keys}
    pair = lambda a, b: rows[a].select(F.lit(a).alias("source_a"), F.lpad(F.col(keys[a]).cast("string"), 9, "0").alias("id_a"), F.lit(b).alias("source_b"), F.lpad((F.col(keys[a]) % most[b]).cast("string"), 9, "0").alias("id_b"), ((F.col(keys[a]) * 7919) % 101).cast("double").alias("score"))
    return resolution.constrained_clusters(records, pair("customer", "supplier").unionByName(pair("part", "customer")), ["supplier", "customer", "part"], staged)


@query(f"""
    WITH {BANDED}, t AS (SELECT c_custkey::VARCHAR AS id_a, m.s AS id_b, c_mktsegment = 'BUILDING' AS hit FROM customer JOIN m ON c_nationkey = m.n),
    x AS (SELECT t.hit, b.state FROM t LEFT JOIN b ON t.id_a = b.id_a AND t.id_b = b.id_b AND b.state IN ('hand', 'auto'))
    SELECT count(*) FILTER (hit AND state IS NOT NULL) / nullif(count(*) FILTER (state IS NOT NULL), 0)::DOUBLE AS precision, count(*) FILTER (hit AND state IS NOT NULL) / nullif(count(*) FILTER (hit), 0)::DOUBLE AS recall,
        count(*) FILTER (hit AND state = 'auto') / nullif(count(*) FILTER (state = 'auto'), 0)::DOUBLE AS auto_precision, count(*) AS labelled FROM x
""")
def d27_link_quality(spark, d):
    """Precision and recall of the linked pairs and of the automatic band, over pairs labelled by the customers' segment."""
    pairs = resolution.banded(_candidates(spark, d), _decisions(spark, d), auto_min=80.0, reject_max=20.0, margin=0.5)
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n")).agg(F.min("s_suppkey").cast("string").alias("id_b"))
    truth = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id_a"), F.col("c_nationkey").alias("n"), F.when(F.col("c_mktsegment") == "BUILDING", "match").otherwise("non_match").alias("label")).join(s, "n")
    return resolution.quality(pairs, truth.select(F.lit("customer").alias("source_a"), "id_a", F.lit("supplier").alias("source_b"), "id_b", "label"))


@query("""
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS day, CASE WHEN o_orderdate::DATE - lag(o_orderdate::DATE) OVER w <= 60 THEN 0 ELSE 1 END AS new FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    i AS (SELECT o_orderkey, o_custkey, sum(new) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS island FROM o)
    SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey, island) AS component FROM i QUALIFY count(*) OVER (PARTITION BY o_custkey, island) > 1
""")
def x00_connected_components(spark, d):
    """Orders that hang together: links lead from each order to the customer's next one within 60 days."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, d, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.datediff(F.col("o_orderdate").cast("date"), F.lag(F.col("o_orderdate").cast("date")).over(w)).alias("days"))
    return connected_components(rows.where("days <= 60").select(F.col("o_orderkey").alias("a"), F.col("before").alias("b")), staged)
