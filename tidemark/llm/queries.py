"""The registered queries of this subpackage: operators applied to whole tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import toxicity as toxic
from tidemark.llm.decontamination import contamination
from tidemark.llm.embedding_dedup import embedding_groups
from tidemark.llm.packing import pack_examples
from tidemark.llm.periodic_runs import periodic_runs
from tidemark.llm.quality import described, fit_described, held_out, score_described
from tidemark.llm.secret_links import secret_spans
from tidemark.llm.sharding import shard_documents
from tidemark.llm.simhash_dedup import simhash_groups
from tidemark.llm.source_audit import source_divergence
from tidemark.llm.storage import written
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import token_counts
from tidemark.llm.url_filter import host_of, judge_captures

Query = Callable[[SparkSession, str], DataFrame]

#: Scores from here on count as label 1.
THRESHOLD = 0.7

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens and 64 segments at most."""
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack_examples(docs, public_tokenizers.path(TOKENIZER), checksums=True)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated windows of 35 words."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_groups(table(spark, sf_dir, "documents"))
    bits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", bits, "component_id")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards, shuffled."""
    return shard_documents(table(spark, sf_dir, "documents"), 24)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector at a cosine of 0.95 or more."""
    return embedding_groups(table(spark, sf_dir, "embeddings"))


EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT vec_id, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id,
       v.vec_id = component_id AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN root USING (vec_id)"""


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by a dated list.

    The table has neither fetch times nor a list, so both are derived from its rows: a page's
    time from its id; for a part of the hosts an entry that blocks them, one that lifts the
    block later, one that allows a folder meanwhile, and a block of every third site.
    """
    pages = table(spark, sf_dir, "pages")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    minutes = F.pmod(F.col("page_id") * 7919, F.lit(525600))
    fetched = (start + F.make_dt_interval(mins=minutes)).alias("fetched")
    captures = pages.select("page_id", "url", fetched)
    # One row per host, whatever the number of its pages.
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    code = F.md5("host")
    day = F.ascii(F.substring(code, 2, 1)) * 2
    since = lambda days: start + F.make_dt_interval(days=days)
    listed = hosts.where(F.substring(code, 1, 1) < "8")
    sites = hosts.select(F.regexp_extract("host", r"[^.]+\.[^.]+$", 0).alias("host")).where("host <> ''").distinct()
    entries = (
        listed.select(F.col("host").alias("rule"), F.lit("block").alias("action"), since(day).alias("since"))
        .unionByName(
            listed.where(F.substring(code, 3, 1) < "8").select(
                F.col("host").alias("rule"), F.lit("allow").alias("action"), since(day + 60).alias("since")
            )
        )
        .unionByName(
            listed.select(
                F.concat("host", F.lit("/en/")).alias("rule"), F.lit("allow").alias("action"), since(day + 30).alias("since")
            )
        )
        .unionByName(
            sites.where(F.substring(code, 1, 1) < "5").select(
                F.col("host").alias("rule"), F.lit("block").alias("action"), since(F.lit(200)).alias("since")
            )
        )
    )
    return judge_captures(captures, entries)


URL_SQL = r"""
WITH captures AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes((page_id * 7919) % 525600) AS fetched,
        rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
        regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
hosts AS (SELECT DISTINCT host, md5(host) AS code FROM captures WHERE host <> ''),
sites AS (SELECT DISTINCT regexp_extract(host, '[^.]+\.[^.]+$') AS host FROM hosts),
listed AS (SELECT host, code, ascii(code[2]) * 2 AS day FROM hosts WHERE code[1] < '8'),
entries AS (
    SELECT host AS rule, 'block' AS action, TIMESTAMP '2024-01-01' + to_days(day) AS since FROM listed
    UNION ALL SELECT host, 'allow', TIMESTAMP '2024-01-01' + to_days(day + 60) FROM listed WHERE code[3] < '8'
    UNION ALL SELECT host || '/en/', 'allow', TIMESTAMP '2024-01-01' + to_days(day + 30) FROM listed
    UNION ALL SELECT host, 'block', TIMESTAMP '2024-01-01' + to_days(200) FROM sites
              WHERE host <> '' AND md5(host)[1] < '5'),
one AS (SELECT rule, since, max(action) AS action FROM entries GROUP BY rule, since),
intervals AS (SELECT rule, action, since AS valid_from,
                     lead(since) OVER (PARTITION BY rule ORDER BY since) AS valid_to FROM one),
labels AS (SELECT *, string_split(host, '.') AS names, string_split(path[2:], '/') AS steps FROM captures WHERE host <> ''),
keys AS (SELECT DISTINCT page_id, url, fetched, key FROM (
    SELECT page_id, url, fetched, unnest(list_concat(
        list_transform(range(1, len(names) + 1), lambda i: array_to_string(names[i:], '.')),
        CASE WHEN len(steps) > 1 THEN list_transform(range(1, len(steps)),
            lambda i: host || '/' || array_to_string(steps[1:i], '/') || '/') ELSE [] END,
        CASE WHEN length(path) > 1 THEN [host || path] ELSE [] END)) AS key FROM labels)),
active AS (SELECT page_id, k.url, fetched, rule, action FROM keys k JOIN intervals i
           ON i.rule = k.key AND valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to)),
best AS (SELECT page_id, url, fetched, count(*) AS n_active,
                arg_max(rule, (contains(rule, '/')::INT, length(rule))) AS rule,
                arg_max(action, (contains(rule, '/')::INT, length(rule))) AS action
         FROM active GROUP BY page_id, url, fetched)
SELECT c.page_id, c.fetched, c.host, CAST(coalesce(n_active, 0) AS BIGINT) AS n_active, rule, action,
       coalesce(action = 'block', false) AS blocked
FROM captures c LEFT JOIN best b ON b.page_id = c.page_id AND b.url = c.url AND b.fetched = c.fetched"""


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learnt from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxic.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~toxic.held_out())
    return toxic.score_toxicity(docs, model).select(
        "doc_id",
        toxic.held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learnt from rows that are not held out."""
    rows = written(described(table(spark, sf_dir, "documents")), "features")
    model = fit_described(rows, table(spark, sf_dir, "labels"), ~held_out())
    return score_described(rows, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


_WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS words FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS words FROM benchmark),
w AS (SELECT DISTINCT item_id, least(13, len(words)) AS n, words[i:i + least(13, len(words)) - 1] AS run
      FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS i
            FROM b WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM w),
runs AS (SELECT r, i, n, words[i:i + n - 1] AS run
         FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
               FROM d, lengths WHERE len(words) >= n)),
hits AS (SELECT r, i, n, item_id FROM runs JOIN w USING (n, run)),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit
        FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""

SUBSTRING_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
           FROM documents),
runs AS (SELECT r, i, words[i:i + 34] AS run
         FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)),
twice AS (SELECT run FROM runs GROUP BY run HAVING count(*) > 1),
gone AS (SELECT r, list(DISTINCT pos) AS gone
         FROM (SELECT r, unnest(range(i, i + 35)) AS pos FROM runs JOIN twice USING (run)) GROUP BY r),
flagged AS (SELECT r, w.pos, w.word, g.pos IS NOT NULL AS dropped
            FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d) w
            LEFT JOIN (SELECT r, unnest(gone) AS pos FROM gone) g USING (r, pos)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT dropped) AS kept,
                count(*) FILTER (WHERE dropped) AS n_removed FROM flagged GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the words of every source differ from those of the others of its language."""
    return source_divergence(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
           FROM documents),
o AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + v.v) AS p,
             1 + 1000000000::HUGEINT * (k.n + 1) // (v.total + v.v) AS q
      FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
           FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, after a tenth of them were made periodic."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", planted("text", "doc_id").alias("text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def planted(text_col: str, id_col: str) -> Column:
    """The text, of a tenth of the ids with words from some place on repeated with a period.

    Without an id the text stays as it is.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    text = F.col(text_col)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
        source = lambda i: F.when(i < first, i).otherwise(first + (i - first) % period)
        new = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, source(i)))
        return F.when(n > 0, F.concat_ws(" ", new)).otherwise(text)

    # The words are cut once, not once for each use.
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated).getItem(0)).otherwise(text)


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, and weak candidates beside complementary parts."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    listed = lambda spans: F.concat_ws(",", F.transform(spans, line))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": toxicity,
        "op2_embedding_neardup": embedding_neardup,
        "op3_packing": packing,
        "op4_url_filters": url_filters,
        "op5_quality": quality,
        "op6_substring_dedup": substring_dedup,
        "op7_simhash": simhash,
        "op8_sharding": sharding,
        "op9_decontamination": decontamination,
        "op10_token_counts": counts,
        "op11_source_divergence": divergence,
        "op12_periodic_runs": periods,
        "op13_secret_scans": secrets,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_neardup": EMBEDDING_SQL,
        "op4_url_filters": URL_SQL,
        "op6_substring_dedup": SUBSTRING_SQL,
        "op9_decontamination": DECONTAMINATION_SQL,
        "op11_source_divergence": DIVERGENCE_SQL,
    }
