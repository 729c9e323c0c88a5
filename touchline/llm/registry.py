"""The registered training-data queries: thin functions over the operators, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.tokens import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.common import work_path
    from touchline.llm.warc import page_records, write_pages

    path = work_path(spark, "warc")
    write_pages(_table(spark, sf_dir, "pages"), path, least_bytes=0)
    return page_records(spark, path).drop("target_uri")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=0, keep_ids=False)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.decontam import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10).drop("items")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.substring import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), window=13, keep_text=False)


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.common import work_path
    from touchline.llm.token_orc import token_offsets, write_token_orc

    path = work_path(spark, "token-orc")
    write_token_orc(_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_offsets(spark, path)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.pii import personal_data

    return personal_data(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.exact import exact_groups

    return exact_groups(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.toxicity import scored

    return scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.simhash import fingerprint_components

    return fingerprint_components(_table(spark, sf_dir, "documents"), radius=4)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.mixing import mixed_sources

    return mixed_sources(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.audit import filter_audit

    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), min_words=200, distinct_percent=50, capital_percent=3)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.llm.ranked import ranked_search

    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=50)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_orc": op5_token_orc,
    "op6_personal_data": op6_personal_data,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_simhash": op9_simhash,
    "op10_token_counts": op10_token_counts,
    "op11_source_mix": op11_source_mix,
    "op12_filter_audit": op12_filter_audit,
    "op13_ranked_search": op13_ranked_search,
}

SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
        g AS (SELECT h, max(page_id) AS top, count(*) AS n FROM p GROUP BY h)
        SELECT p.page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(p.x, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
            CASE WHEN g.n > 1 AND p.page_id <> g.top THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN g.n > 1 AND p.page_id <> g.top THEN g.top END AS refers_to
        FROM p JOIN g ON p.h = g.h
    """,
    "op3_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        t AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
        g AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)),
        m AS (SELECT g.doc_id, g.i, g.n, t.item_id FROM g JOIN t ON g.n = t.n AND g.s = t.s),
        h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM m) GROUP BY doc_id),
        k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(k.n_items, 0)::BIGINT AS n_items, sha256(coalesce(k.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
    """,
    "op4_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
        f AS (SELECT s, min(doc_id) AS lo FROM g GROUP BY s),
        r AS (SELECT DISTINCT doc_id, i + o AS j FROM (SELECT g.doc_id, g.i, unnest(range(0, 13)) AS o FROM g JOIN f ON g.s = f.s WHERE f.lo < g.doc_id)),
        k AS (SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.j) AS kept, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d) a
              LEFT JOIN r ON a.doc_id = r.doc_id AND a.j = r.j WHERE r.j IS NULL GROUP BY a.doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id
    """,
    "op7_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM n JOIN g ON n.t = g.t
    """,
    "op11_source_mix": r"""
        WITH r AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
        s AS (SELECT source, sum(size)::HUGEINT AS total, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM r GROUP BY source),
        c AS (SELECT *, row_number() OVER (ORDER BY total::DOUBLE / weight, source) AS k, sum(total) OVER () AS budget FROM s),
        p AS (SELECT *, budget - 3 * coalesce(sum(total) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over, sum(weight) OVER (ORDER BY k DESC) AS weights FROM c),
        f AS (SELECT *, 3 * total * weights < left_over * weight AS capped FROM p),
        lv AS (SELECT (any_value(budget) - 3 * coalesce(sum(total) FILTER (capped), 0))::DOUBLE AS left_over, (sum(weight) FILTER (NOT capped))::DOUBLE AS weights FROM f),
        t AS (SELECT source, total, CASE WHEN capped THEN (3 * total)::DOUBLE ELSE weight::DOUBLE * lv.left_over / lv.weights END AS target FROM f, lv),
        n AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total::DOUBLE)::BIGINT ELSE 0 END AS repeats FROM t),
        w AS (SELECT r.doc_id, r.size, n.total, n.target, n.repeats, n.target - n.repeats * n.total::DOUBLE AS need,
                sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h) AS run, sum(r.size) OVER (PARTITION BY r.source, r.h) AS own
              FROM r JOIN n ON r.source IS NOT DISTINCT FROM n.source)
        SELECT doc_id, size, total::BIGINT AS source_size, target,
            (size * (repeats + CASE WHEN run <= need OR (run - own <= need AND need - (run - own) > own / 2) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM w
    """,
    "op12_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        c AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, length(t) AS chars, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals FROM d),
        k AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        m AS (SELECT c.part, (len(w) < 200)::INT AS a, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS b, (100 * capitals > 3 * chars)::INT AS c, regexp_matches(t, '[#$%&*|]')::INT AS d,
                (coalesce(c.doc_id > min(c.doc_id) OVER (PARTITION BY t), false))::INT AS e, coalesce(k.good, false) AS good, coalesce(k.toxic, false) AS toxic FROM c LEFT JOIN k ON c.doc_id = k.doc_id),
        f AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
        l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
        o AS (SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits FROM l p, l q, l r, l s, l t WHERE p.bit | q.bit | r.bit | s.bit | t.bit = 31),
        g AS (SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step - 1]) AS before FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
        x AS (SELECT part, filter_order, step::INT AS step, own, coalesce(before, 0)::INT AS before, mask, n, good, toxic FROM g, f),
        y AS (SELECT part, filter_order, step, any_value(own) AS own,
                coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & own > 0 AND mask & before = 0), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (mask & own > 0 AND mask & before > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (mask & own > 0 AND mask & before = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
              FROM x GROUP BY part, filter_order, step)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM y
    """,
    "op13_ranked_search": r"""
        WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        t AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
        d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
        g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM d),
        m AS (SELECT doc_id, 50 + (50 * n * docs) // words AS m FROM d, g),
        i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM t, g WHERE term IN (SELECT term FROM i) GROUP BY term, docs),
        s AS (SELECT item_id, t.doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM i JOIN f USING (term) JOIN t USING (term) JOIN m ON m.doc_id = t.doc_id GROUP BY ALL),
        r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
    """,
}
