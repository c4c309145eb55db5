"""The corpus operators as named queries over the tables of a folder, and their DuckDB twins where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm import bpe, decontam, hard_negatives, html_extract, langid, mixing, quality, quotes, rlz_dedup, sharding, simhash, url_reputation, whitening
from clickscope.llm.common import saved, table, utf8_size, words

SHARDS = 16
WINDOW_WORDS = 50
FINGERPRINT_BITS = 2

# The url rules.
URL_RULES = [url_reputation.Rule("net/", "block"), url_reputation.Rule("example.net/en/", "allow"),
             url_reputation.Rule("example.com/de/", "block"), url_reputation.Rule("org/fr/", "allow")]


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return sharding.kd_shards(docs, n_shards=SHARDS).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_line_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op3_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotations(table(spark, sf_dir, "conversations"))


def op4_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz_dedup.dedup_substrings(table(spark, sf_dir, "documents"), WINDOW_WORDS)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of the page with the same id: a page is bad if it is toxic or of low quality."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_reputation.filter_urls(pages, page_outcomes(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prints = saved(docs.select("doc_id", simhash.fingerprint(F.col("text")).alias("fp")), "simhash-prints")
    found = simhash.near_duplicates(prints, FINGERPRINT_BITS)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def _held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def language_model(spark: SparkSession, sf_dir: str) -> langid.Model | None:
    """Trained on the labelled documents that are not held out."""
    return langid.train(table(spark, sf_dir, "documents").where(~_held_out()).select("text", "lang"))


def op8_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    named = langid.identify(docs, language_model(spark, sf_dir))
    return named.select("doc_id", _held_out().alias("held_out"), "__lang.lang_pred", "__lang.score", "__lang.accepted")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    plan = mixing.mix_plan(saved(sizes, "mix-sizes"))
    return plan.select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"))


def op10_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_angular_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mine_hard_negatives(rows, lambda ids: ids % 100 == 0)


def op13_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder_of = bpe.encoder(spark, public_tokenizers.path("word_bpe_49k.json"))
    ids = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), encoder_of).alias("ids"))
    decoded = ids.withColumn("decoded", bpe.decode(F.col("ids"), encoder_of))
    return decoded.select("doc_id", bpe.id_count(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_kd_shards, op2_line_block_text, op3_quotation_links, op4_rlz_dedup, op5_host_reputation,
                            op6_benchmark_containment, op7_simhash_components, op8_subword_langid, op9_source_mix,
                            op10_robust_quality, op11_embedding_whitening, op12_angular_hard_negatives,
                            op13_forced_boundary_bpe)}

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

ORACLE_SQL = {
    "op4_rlz_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
                FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM d)),
        firsts AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
        covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
                    FROM win JOIN firsts USING (h) WHERE f < doc_id),
        gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM covered GROUP BY doc_id),
        word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t
                 FROM word ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op5_host_reputation": r"""
        WITH p AS (SELECT page_id, url,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        o AS (SELECT doc_id AS page_id, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad, count(*) AS n
              FROM labels WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY doc_id),
        h AS (SELECT host, coalesce(sum(bad), 0) AS bad, coalesce(sum(n), 0) AS n, string_split(host, '.') AS l,
                     CASE WHEN array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') IN
                          ('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.za', 'co.in', 'co.jp',
                           'ne.jp', 'or.jp', 'co.kr', 'com.br', 'com.cn', 'com.mx', 'com.tr', 'com.tw') THEN 2 ELSE 1 END AS deep
              FROM p LEFT JOIN o USING (page_id) GROUP BY host),
        hd AS (SELECT host, CAST(bad AS DOUBLE) AS bad, CAST(n AS DOUBLE) AS n, array_to_string(list_slice(l, -deep - 1, -1), '.') AS domain,
                      array_to_string(list_slice(l, -deep, -1), '.') AS suffix FROM h),
        dm AS (SELECT suffix, domain, sum(bad) AS bad, sum(n) AS n, sum(CASE WHEN n > 0 THEN bad * bad / n END) AS spread,
                      sum(n * n) AS square, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) - 1 AS more FROM hd GROUP BY suffix, domain),
        sx AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n, sum(CASE WHEN n > 0 THEN bad * bad / n END) AS spread,
                      sum(n * n) AS square, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) - 1 AS more FROM dm GROUP BY suffix),
        al AS (SELECT sum(bad) AS bad, sum(n) AS n, sum(CASE WHEN n > 0 THEN bad * bad / n END) AS spread,
                      sum(n * n) AS square, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) - 1 AS more FROM sx),
        lv AS (SELECT 'h' AS level, * EXCLUDE (suffix, domain) FROM dm UNION ALL SELECT 'd', * EXCLUDE (suffix) FROM sx
               UNION ALL SELECT 's', * FROM al),
        mo AS (SELECT level, sum(spread - bad * bad / n - bad / n * (1 - bad / n) * more) AS over,
                      sum(bad / n * (1 - bad / n) * (n - square / n - more)) AS room FROM lv WHERE n > 0 GROUP BY level),
        st AS (SELECT level, CASE WHEN room > 0 AND over > 0 THEN least(greatest(room / over - 1, 1.0), 1000.0) ELSE 1000.0 END AS s FROM mo),
        q AS (SELECT coalesce(max(CASE WHEN level = 'h' THEN s / (s + 1) END), 1000.0 / 1001) AS qh,
                     coalesce(max(CASE WHEN level = 'd' THEN s / (s + 1) END), 1000.0 / 1001) AS qd,
                     coalesce(max(CASE WHEN level = 's' THEN s / (s + 1) END), 1000.0 / 1001) AS qs FROM st),
        s1 AS (SELECT sx.*, al.n - sx.n + 1.0 AS rest,
                      (al.bad - sx.bad + CASE WHEN al.n > 0 THEN al.bad / al.n ELSE 0.0 END) / (al.n - sx.n + 1.0) AS m FROM sx, al),
        s2 AS (SELECT suffix, bad, n, m, rest / (rest + 1) * qs / (1 - rest / (rest + 1) * qs) AS w FROM s1, q),
        d1 AS (SELECT suffix, domain, dm.bad, dm.n, s2.n - dm.n + w AS rest, (s2.bad - dm.bad + w * m) / (s2.n - dm.n + w) AS m
               FROM dm JOIN s2 USING (suffix)),
        d2 AS (SELECT suffix, domain, bad, n, m, rest / (rest + 1) * qd / (1 - rest / (rest + 1) * qd) AS w FROM d1, q),
        h1 AS (SELECT host, hd.bad, hd.n, d2.n - hd.n + w AS rest, (d2.bad - hd.bad + w * m) / (d2.n - hd.n + w) AS m
               FROM hd JOIN d2 USING (suffix, domain)),
        h2 AS (SELECT host, bad, n, m, rest / (rest + 1) * qh / (1 - rest / (rest + 1) * qh) AS w FROM h1, q),
        ab AS (SELECT host, greatest(bad + w * m, 1e-9) AS a, greatest(n - bad + w * (1 - m), 1.0) AS b FROM h2),
        cd AS (SELECT host, a, b, 1 / (9 * a) AS c, 1 / (9 * b) AS d FROM ab),
        fr AS (SELECT host, a, b, pow(greatest(((1 - c) * (1 - d) - 1.645 * sqrt(c * (1 - d) * (1 - d) + d * (1 - c) * (1 - c) - 2.706025 * c * d))
                                               / ((1 - d) * (1 - d) - 2.706025 * d), 0.0), 3) AS f FROM cd),
        j AS (SELECT page_id, host, path, a * f / (b + a * f) AS low,
              CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                   WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                   WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                   WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
              FROM p JOIN fr USING (host))
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM j""",
    "op6_benchmark_containment": f"""
        WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
        it AS (SELECT item_id, text AS raw, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), a, b)")} AS w FROM benchmark, low),
        dw AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), a, b)")} AS w FROM documents, low),
        s AS (SELECT DISTINCT item_id, raw, array_to_string(list_slice(w, i, i + 4), ' ') AS g
              FROM (SELECT item_id, raw, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM it)),
        t AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM dw)),
        n AS (SELECT item_id, raw, count(*) AS n_shingles FROM s GROUP BY item_id, raw),
        c AS (SELECT doc_id, item_id, raw, count(*) AS n_shared FROM s JOIN t USING (g) GROUP BY doc_id, item_id, raw)
        SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(n_shared AS BIGINT) AS n_shared,
               CAST(n_shared AS DOUBLE) / n_shingles AS containment
        FROM c JOIN n USING (item_id, raw) WHERE n_shared >= 0.8 * n_shingles""",
    "op9_source_mix": f"""
        WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
                          md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                     (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
        o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS nth FROM s),
        l AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                     sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM o),
        v AS (SELECT rest AS r, open AS q FROM l WHERE CAST(cap AS DOUBLE) * open > CAST(rest AS DOUBLE) * weight ORDER BY nth LIMIT 1),
        t AS (SELECT source, source_size,
                     CASE WHEN r IS NULL OR CAST(cap AS DOUBLE) * q <= CAST(r AS DOUBLE) * weight THEN CAST(cap AS DOUBLE)
                          ELSE CAST(r AS DOUBLE) * weight / CAST(q AS DOUBLE) END AS target FROM l LEFT JOIN v ON true),
        b AS (SELECT source, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
                     CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
        x AS (SELECT doc_id, size, b.source_size, target, epochs, budget - epochs * b.source_size AS rest,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, size, source_size, target,
               CAST(epochs * size + CASE WHEN before < rest THEN least(size, rest - before) ELSE 0 END AS BIGINT) AS taken FROM x""",
    "op12_angular_hard_negatives": """
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id AS id, r.label, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
              FROM r AS a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE label <> own AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5""",
}
