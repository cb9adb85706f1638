"""The queries opN_<name> over the driver's tables, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import additive_ann, centroids, compression_quality, license_sentences, media, mixing, packing, periodic_runs, repeats, simhash, toxicity, url_reputation, warc
from quarry.llm.common import table

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_sentences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_known"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", simhash.hex64("fp").alias("fingerprint"), "component_id")


def op4_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_ann.neighbours(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0, k=20)


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(), max_len=4096, end_id=1, cache_bytes=224 << 20)


#: Wanted shares of tokens by domain, here the languages of the labelled documents.
MIX_TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id"), "doc_id")
    rated, domains, reached = mixing.mix(docs, labelled, MIX_TARGETS, keep=["doc_id"])
    mixing.demand(reached, MIX_TARGETS)
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(domains)]
    return rated.select(F.col("row.doc_id").alias("doc_id"), F.col("tokens").cast("long").alias("tokens"), *shares, "rate")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repeats.remove_repeats(docs, length=100, keep=["doc_id"], kept_text=False)


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the page's document, whose id ends its path, is labelled bad (quality 0)."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    made = pages.select("url", F.expr("try_cast(regexp_extract(url, '/([0-9]+)[^/]*$', 1) as bigint)").alias("doc_id"))
    outcomes = made.join(labels.select("doc_id", (1 - F.col("quality")).alias("bad")), "doc_id").select("url", "bad")
    return url_reputation.filter_urls(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out third."""
    return labels.where(F.expr("crc32(cast(doc_id as string)) % 3") != 1)


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = compression_quality.train(docs, training_labels(labels))
    held_out = (F.expr("crc32(cast(doc_id as string)) % 3") == 1).alias("held_out")
    scored = compression_quality.score(docs, model, keep=["doc_id", held_out])
    return scored.select("doc_id", "held_out", F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where crc32(doc_id) ends in 0, the words from a on repeat the p words there; a and p follow from the rest of that number."""
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = hashed.select("doc_id", "text", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("w"), F.floor(F.col("h") / 10).alias("g"))
    at = words.select("*", F.when(F.size("w") > 0, F.expr("cast(g % size(w) as int)")).alias("a"))
    period = at.select("*", F.expr("cast(1 + floor((size(w) - a) / (3 + g % 8)) as int)").alias("p"))
    made = F.expr("array_join(transform(w, (x, i) -> if(i >= a, w[a + (i - a) % p], x)), ' ')")
    return period.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")), keep=["doc_id"], min_words=24, exponent=3)
    best, lines = periodic_runs.strongest("runs"), F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.select("doc_id", "runs", best.alias("best"), F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"), "collapsed")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), dimension=64, k=8, rounds=10, scale=1024, seed="3")
    digest = F.sha2(F.array_join("centroid", ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, training_labels(labels))
    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3") == 1, F.lit(False)).alias("held_out")
    scored = toxicity.score(docs, model, keep=["doc_id", held_out])
    return scored.select("doc_id", "held_out", F.col("toxicity_score").alias("score"), (F.col("toxicity_score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_license_sentences, op3_simhash, op4_additive_ann, op5_packing, op6_mixing, op7_repeats, op8_url_reputation, op9_compression_quality, op10_media, op11_periodic_runs, op12_centroids, op13_toxicity)}

ORACLES: dict[str, str] = {}

ORACLES["op1_warc"] = """
WITH p AS (SELECT page_id, coalesce(encode(html), ''::BLOB) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) AS k, min(page_id) OVER (PARTITION BY h) AS first_id FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND k > 1 THEN first_id END AS refers_to
FROM f
"""


def _license_oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(s)}, {quoted(i)})" for s, i in license_sentences.sentence_table())
    rules = ", ".join(f"({k}, {quoted(name)}, {quoted(''.join(f'|{i}|' for i in ids))})" for k, name, ids in license_sentences.rule_table())
    ws = license_sentences.SPACES.replace("\\\\", "\\")
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE known(sentence, id) AS (VALUES {known}),
rules(k, name, seen) AS (VALUES {rules}),
low AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(translate(coalesce(text, ''), '{up}', '{low}'), '{license_sentences.TAG}', 'spdx-license-identifier ', 'g') AS t FROM documents),
marked AS (SELECT rid, doc_id, regexp_replace(regexp_replace(t, '([.!?:;]){ws}+', '\\1' || chr(1), 'g'), '\\n{ws}*\\n', chr(1), 'g') AS t FROM low),
parts AS (SELECT rid, doc_id, unnest(string_split(t, chr(1))) AS s, generate_subscripts(string_split(t, chr(1)), 1) AS i FROM marked),
cut AS (SELECT rid, doc_id, i, 0 AS j, s FROM parts UNION ALL
        SELECT rid, doc_id, i, generate_subscripts(string_split(s, chr(10)), 1), unnest(string_split(s, chr(10))) FROM parts WHERE contains(s, chr(10))),
norm AS (SELECT rid, i, j, regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(s, '[^a-z0-9.]+', ' ', 'g') || ' ', '\\.+ ', ' ', 'g')), '{license_sentences.UNDER}', 'under '), '{license_sentences.HOLDER}', '{license_sentences.NAMES}') AS s FROM cut),
hits AS (SELECT rid, list(id ORDER BY i, j) AS ids FROM norm JOIN known ON norm.s = known.sentence GROUP BY rid),
tried AS (SELECT rid, 0 AS n, '|' || array_to_string(ids, '||') || '|' AS rest, CAST([] AS VARCHAR[]) AS found FROM hits
          UNION ALL
          SELECT rid, n + 1, CASE WHEN contains(rest, seen) THEN replace(rest, seen, '#') ELSE rest END,
                 CASE WHEN contains(rest, seen) AND NOT list_contains(found, name) THEN list_append(found, name) ELSE found END
          FROM tried JOIN rules ON rules.k = n)
SELECT doc_id, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_known, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(found, ','), '') AS licenses
FROM low LEFT JOIN hits USING (rid) LEFT JOIN (SELECT rid, found FROM tried WHERE n = (SELECT count(*) FROM rules)) USING (rid)
"""


ORACLES["op2_license_sentences"] = _license_oracle()


def _url_oracle() -> str:
    fits = " ".join(
        f"WHEN (host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '{s + t}') THEN '{action}|{rule}'"
        for action, rule in sorted(URL_RULES, key=lambda r: -len(r[1]))
        for n, s, t in [rule.partition("/")]
    )
    long = ", ".join(f"'{s}'" for s in url_reputation.LONG_SUFFIXES)
    ruled = "|".join(url_reputation.SECOND_LEVEL)
    site = "regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]$', '')"

    def strength(of: str) -> str:
        return f"""SELECT (1 - b) / b AS m FROM (SELECT least(greatest(coalesce((spread - v * (k - 1)) / nullif(v * (total - squares / nullif(total, 0) - (k - 1)), 0), 0.01), 0.001), 0.5) AS b
        FROM (SELECT sum(n) AS total, sum(n * n) AS squares, count(*) AS k, sum(n * (bad / n - parent) * (bad / n - parent)) AS spread, sum(n * parent * (1 - parent)) / nullif(sum(n), 0) AS v FROM {of}))"""

    parse = """CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN instr(url, '://') > 0 THEN regexp_extract(regexp_replace(substr(url, instr(url, '://') + 3), '^[^/?#]*', ''), '^[^?#]*', 0) ELSE '' END AS path"""
    suffix_labels = f"CASE WHEN array_to_string(l[-2:], '.') IN ({long}) OR regexp_matches(array_to_string(l[-2:], '.'), '^({ruled})[.][a-z][a-z]$') THEN 2 ELSE 1 END"
    return f"""
WITH parsed AS (SELECT page_id, url, {parse} FROM pages),
outcomes AS (SELECT {site} AS host, CAST(1 - quality AS DOUBLE) AS bad FROM parsed JOIN labels ON labels.doc_id = try_cast(regexp_extract(url, '/([0-9]+)[^/]*$', 1) AS BIGINT) WHERE quality IS NOT NULL),
h0 AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, sum(bad) AS bad, string_split(host, '.') AS l FROM outcomes GROUP BY host),
h1 AS (SELECT *, {suffix_labels} AS k FROM h0),
h AS (SELECT host, n, bad, array_to_string(l[-k:], '.') AS suffix, array_to_string(l[-(k + 1):], '.') AS domain FROM h1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
sp AS (SELECT s.*, (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM s) AS parent FROM s),
sm AS ({strength("sp")}),
sr AS (SELECT suffix, (bad + m * parent) / (n + m) AS rate FROM sp, sm),
dp AS (SELECT d.*, rate AS parent FROM d JOIN sr USING (suffix)),
dm AS ({strength("dp")}),
dr AS (SELECT domain, suffix, (bad + m * parent) / (n + m) AS rate FROM dp, dm),
hp AS (SELECT h.*, rate AS parent FROM h JOIN dr USING (domain, suffix)),
hm AS ({strength("hp")}),
hr AS (SELECT host, (bad + m * parent) / (n + m) AS rate, n + m AS size FROM hp, hm),
sites AS (SELECT *, {site} AS site FROM parsed),
cut AS (SELECT page_id, host, path, site, string_split(site, '.') AS l FROM sites),
named AS (SELECT *, {suffix_labels} AS k FROM cut),
known AS (SELECT page_id, p.host, path, coalesce(hr.rate, dr.rate, sr.rate, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM s)) AS rate,
          CASE WHEN hr.rate IS NOT NULL THEN hr.size WHEN dr.rate IS NOT NULL THEN hm.m WHEN sr.rate IS NOT NULL THEN dm.m ELSE sm.m END AS size
          FROM named p CROSS JOIN sm CROSS JOIN dm CROSS JOIN hm LEFT JOIN hr ON hr.host = site
          LEFT JOIN dr ON dr.domain = array_to_string(l[-(k + 1):], '.') AND dr.suffix = array_to_string(l[-k:], '.') LEFT JOIN sr ON sr.suffix = array_to_string(l[-k:], '.')),
judged AS (SELECT page_id, host, path, rate - 1.645 * sqrt(rate * (1 - rate) / (size + 1)) AS low, CASE {fits} END AS hit FROM known)
SELECT page_id, host, path, split_part(hit, '|', 2) AS rule,
       CASE WHEN hit IS NOT NULL THEN split_part(hit, '|', 1) WHEN low > 0.2 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


ORACLES["op8_url_reputation"] = _url_oracle()


def _centroid_oracle(k: int = 8, rounds: int = 10) -> str:
    """Rounds as a chain of tables; sums and distances as 128-bit integers."""
    far = "list_sum([CAST(x[i] - c[i] AS HUGEINT) * (x[i] - c[i]) for i in range(1, 65)])"
    near = f"SELECT vec_id, x, arg_min(j, (d, j)) AS j, min(d) AS d FROM (SELECT rid, vec_id, x, j, {far} AS d FROM vectors CROSS JOIN {{c}}) GROUP BY rid, vec_id, x"
    chain = [f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS j, x AS c FROM vectors WHERE vec_id IS NOT NULL ORDER BY j LIMIT {k})"]
    for r in range(rounds):
        sums = f"SELECT j, i, sum(v) AS s, count(*) AS n FROM (SELECT j, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM ({near.format(c=f'c{r}')})) GROUP BY j, i"
        fresh = f"SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM ({sums}) GROUP BY j"
        chain.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.j, coalesce(f.c, c{r}.c) AS c FROM c{r} LEFT JOIN ({fresh}) f ON f.j = c{r}.j)")
    return f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT) for v in embedding] AS x FROM embeddings
    WHERE len(embedding) = 64 AND len([v for v in embedding if v IS NOT NULL AND isfinite(v)]) = 64),
{", ".join(chain)},
last AS MATERIALIZED ({near.format(c=f"c{rounds}")})
SELECT vec_id, CAST(last.j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY last.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c{rounds} ON c{rounds}.j = last.j
"""


ORACLES["op12_centroids"] = _centroid_oracle()
