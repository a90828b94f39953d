"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions.rng import uniform_sql
from arealis.llm import centroids, chat, decontaminate, fingerprints, mixing, near_dedup, pii, repeats, secrets, sharding, spans, token_counts, toxicity, variants
from arealis.llm.common import staged, text_of, word_count
from arealis.llm.registry import query, table


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    """All documents in 8 shards of equal counts, in random order."""
    text = text_of("text")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.shard_uniformly(docs, 8, seed=11)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def double(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def time_sql(share: str, weight_class: str, schedules: tuple) -> str:
    """DuckDB text of ``mixing.time_of``: the inverse of the integral of each broken line."""
    out = "NULL"
    for cls, line in reversed(list(enumerate(schedules))):
        areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(line, line[1:], strict=False)]
        total, met, pieces = sum(areas), 0.0, []
        for ((t0, r0), (t1, r1)), area in zip(zip(line, line[1:], strict=False), areas, strict=True):
            more = f"({share} * {double(total)} - {double(met)})"
            root = f"sqrt(greatest({double(r0 * r0)} + {double(4 * (r1 - r0) / (2 * (t1 - t0)))} * {more}, CAST(0 AS DOUBLE)))"
            met += area
            pieces.append((met / total, f"{double(t0)} + CASE WHEN {more} <= 0 THEN CAST(0 AS DOUBLE) ELSE 2 * {more} / ({double(r0)} + {root}) END"))
        piece = pieces[-1][1]
        for end, value in reversed(pieces[:-1]):
            piece = f"CASE WHEN {share} <= {double(end)} THEN {value} ELSE {piece} END"
        out = f"CASE WHEN {weight_class} = {cls} THEN {piece} ELSE {out} END"
    return out


TIME = time_sql("share", "class", (mixing.FALLING, mixing.EVEN, mixing.RISING))
MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, CASE class WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM sources)
), levels AS (
  SELECT *, CAST((sum(source_size) OVER ())
      - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ranked
), targets AS (
  SELECT source, source_size, class, least(weight * max(CASE WHEN weight * level <= 3 * source_size THEN level END) OVER (), CAST(3 * source_size AS DOUBLE)) AS target FROM levels
), placed AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY {uniform_sql("mix", "doc_id", "source", "size")}, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM sized
)
SELECT doc_id, size, source_size, target, taken, round(time, 9) AS time, CASE WHEN time IS NOT NULL THEN row_number() OVER (ORDER BY time NULLS LAST, doc_id, size) - 1 END AS position
FROM (SELECT *, CASE WHEN first > 0 THEN {TIME} END AS time FROM (
  SELECT *, (start + first / CAST(2 AS DOUBLE)) / target AS share,
    CAST(first + greatest(0, least(size, words - source_size - start)) + greatest(0, least(size, words - 2 * source_size - start)) AS BIGINT) AS taken
  FROM (SELECT placed.*, source_size, target, class, CAST(floor(target) AS BIGINT) AS words, greatest(0, least(size, CAST(floor(target) AS BIGINT) - start)) AS first
    FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source)))
"""


@query("op4_mixing", MIX_SQL)
def op4_mixing(spark, sf_dir):
    """Words that the mix takes from each document, and when and in which order documents are first read."""
    docs = table(spark, sf_dir, "documents")
    slim = staged(docs.select("doc_id", "source", word_count(F.col("text").cast("string")).alias("n_words")))
    ordered = mixing.training_order(mixing.plan_mix(slim, words="n_words"))
    return ordered.select("doc_id", "size", "source_size", "target", "taken", F.round("time", 9).alias("time"), "position")


@query("op3_fingerprints")
def op3_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts, and their likeness."""
    return fingerprints.edit_test(table(spark, sf_dir, "documents").select("doc_id", "text"))


def shingle_sql(name: str, table_name: str, key: str) -> str:
    """Common table expression: distinct five-word shingles of a table's texts; a text of fewer words is one shingle."""
    return f"""{name}_words AS (
  SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table_name}
), {name} AS (
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM {name}_words
)"""


CONTAINED_SQL = f"""
WITH {shingle_sql("item_sets", "benchmark", "item_id")}, {shingle_sql("doc_sets", "documents", "doc_id")},
item_sizes AS (SELECT item_id, count(*) AS n_item FROM item_sets GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM doc_sets JOIN item_sets USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, CAST(n_shared AS DOUBLE) / CAST(n_item AS DOUBLE) AS containment
FROM shared JOIN item_sizes USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""


@query("op7_decontaminate", CONTAINED_SQL)
def op7_decontaminate(spark, sf_dir):
    """Benchmark items that documents hold, with the share of the item's shingles."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contained_items(docs, items)
    share = F.col("n_shared").cast("double") / F.col("n_item")
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_item", "n_shared", share.alias("containment"))


NEAR_SQL = f"""
WITH RECURSIVE {shingle_sql("sets", "documents", "doc_id")},
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s >= 85 * (x.n + y.n - s)),
reach AS (SELECT doc_id AS v, doc_id AS r FROM documents UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach JOIN documents ON v = doc_id LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@query("op5_near_dedup", NEAR_SQL)
def op5_near_dedup(spark, sf_dir):
    """Near-duplicate class of every document at 85 %."""
    classes = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return classes.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from two thirds of the labels."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.fit_on_table(docs, labels, keep="crc32(cast(cast(doc_id as string) as binary)) % 3 != 1")
    scored = toxicity.score_toxicity(docs, model)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    spans = F.array_join(F.transform("toxic_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return scored.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"), spans.alias("spans"))


@query("op9_secrets")
def op9_secrets(spark, sf_dir):
    """Secrets in every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    counts = [spans.count_kind("secrets", k).alias(f"n_{k}") for k in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(spans.joined("secrets", secrets.BASE_KINDS), 256).alias("base_sha256"), spans.joined("secrets").alias("spans"))


@query("op10_pii")
def op10_pii(spark, sf_dir):
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit_on_table(docs)).drop("text")
    counts = [spans.count_kind("personal", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(spans.joined("personal", pii.KINDS), 256).alias("base_sha256"), spans.joined("personal").alias("spans"))


@query("op6_chat")
def op6_chat(spark, sf_dir):
    """Repaired roles and rendered pieces of all conversations."""
    return chat.repair_roles(table(spark, sf_dir, "conversations")).drop("position")


REPEAT_SQL = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents
), strings AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM docs WHERE n >= 100)
), firsts AS (
  SELECT s, min((doc_id, i)) AS first FROM strings GROUP BY s HAVING count(*) > 1
), later AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM strings JOIN firsts USING (s) WHERE (doc_id, i) <> first
), runs AS (
  SELECT doc_id, r, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM later) GROUP BY doc_id, r
), pieces AS (
  SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), cut AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""


@query("op2_suffix_array", REPEAT_SQL)
def op2_suffix_array(spark, sf_dir):
    """All documents without the bytes of strings of 100 bytes that start earlier."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


CENTROID_ROUNDS = 3


def centroid_sql(rounds: int) -> str:
    """Lloyd rounds with integer components, one pair of common table expressions a round."""
    floor = "CAST((s - ((s % n) + n) % n) / n AS BIGINT)"
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    parts = [
        """WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cents0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, vec_id, v) - 1 AS INTEGER) AS k, v AS c
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, vec_id, v FROM kept ORDER BY h, vec_id, v LIMIT 16)
), numbered AS (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, vec_id, v FROM kept)"""
    ]
    for i in range(rounds + 1):
        parts.append(f"near{i} AS (SELECT r, vec_id, v, min((d, k)) AS best FROM (SELECT r, vec_id, v, k, CAST({distance} AS BIGINT) AS d FROM numbered CROSS JOIN cents{i}) GROUP BY r, vec_id, v)")
        if i < rounds:
            sums = f"SELECT best[2] AS k, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM near{i}, unnest(range(1, 65)) AS t(i) GROUP BY 1, 2"
            parts.append(f"cents{i + 1} AS (SELECT k, coalesce(m, c) AS c FROM cents{i} LEFT JOIN (SELECT k, list({floor} ORDER BY i) AS m FROM ({sums}) GROUP BY k) USING (k))")
    tail = f"""SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM near{rounds} JOIN cents{rounds} ON k = best[2]"""
    return ", ".join(parts) + " " + tail


@query("op13_centroids", centroid_sql(CENTROID_ROUNDS))
def op13_centroids(spark, sf_dir):
    """Cluster of every vector after three rounds."""
    out = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), rounds=CENTROID_ROUNDS)
    digest = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


VARIANT_SQL = """
WITH RECURSIVE steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)
), runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run
), bytes AS (
  SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(ch) - 64 AS BIGINT)] END)) AS b FROM runs
), hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM bytes, steps
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, k FROM hashed
), vocabulary AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM vocabulary)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min((-m, other)) AS top FROM near GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 5 * n THEN top[2] END AS form, CASE WHEN -top[1] >= 5 * n THEN -top[1] END AS form_n FROM vocabulary LEFT JOIN best USING (word)
), chain AS (
  SELECT word, coalesce(form, word) AS last, form IS NULL AS done FROM formed
  UNION ALL SELECT chain.word, coalesce(f.form, chain.last), f.form IS NULL FROM chain JOIN formed f ON f.word = chain.last WHERE NOT done
)
SELECT word, form, last AS root, n, n_near, form_n FROM formed JOIN chain USING (word) WHERE done
"""


@query("op12_variants", VARIANT_SQL)
def op12_variants(spark, sf_dir):
    """Spelling variants of the words of all documents, with a letter dropped from one run in 199."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"), typo_every=199)


@query("op11_token_counts")
def op11_token_counts(spark, sf_dir):
    """Tokens of every document under the public word vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs)
    size = F.octet_length(text_of("text")).cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
