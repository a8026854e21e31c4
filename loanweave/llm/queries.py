"""The operators as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.session import stage

from . import (
    bfd_shards,
    bin_slack,
    character_references,
    ctw_scores,
    fill_in_middle,
    passage_chains,
    pii_bootstrap,
    ppm_language,
    repeated_bytes,
    simhash_groups,
    simhash_tables,
    vector_codes,
    warc_derivatives,
    wu_manber,
)

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path() -> str:
    """The vocabulary file on each machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The table of pages has no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"


@query
def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derivatives.responses(table(spark, sf_dir, "pages"), CAPTURED)
    return warc_derivatives.derivatives(responses, ["page_id"])


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_id(*parts: str) -> str:
    name = f"md5(concat_ws(chr(10), {', '.join(parts)}))"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({name}, {a}, {n})" for a, n in cuts) + " || '>'"


def _sql_plain(html: str) -> str:
    text = f"regexp_replace({html}, {_sql_text(warc_derivatives.HIDDEN)}, ' ', 'g')"
    text = f"regexp_replace({text}, {_sql_text(warc_derivatives.BREAKS)}, chr(10), 'g')"
    text = f"regexp_replace({text}, {_sql_text(warc_derivatives.TAGS)}, '', 'g')"
    text = character_references.sql_resolved(text, "names")
    return _sql_joined(f"replace({text}, chr(160), ' ')")


def _sql_link(value: str) -> str:
    text = character_references.sql_resolved(f"regexp_replace({value}, '^[\"'']|[\"'']$', '', 'g')", "names")
    return f"regexp_replace({text}, '[\\t\\r\\n]', '', 'g')"


def _sql_joined(text: str) -> str:
    text = f"regexp_replace({text}, '[ \\t\\r\\f\\x0B]+', ' ', 'g')"
    text = f"regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({text}, '^[ \\n]+|[ \\n]+\\z', '', 'g')"


ORACLES["op1_warc_derivatives"] = f"""
WITH nl AS (SELECT chr(13) || chr(10) AS nl, {character_references.sql_names()} AS names),
source AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
parsed AS (SELECT source.*, nl, names, {_sql_id("'response'", "coalesce(CAST(page_id AS VARCHAR), '')", "target_uri", "payload")} AS refers_to,
  concat_ws(nl, 'HTTP/1.1 200 OK', 'Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(payload)) AS source_headers,
  'sha256:' || sha256(payload) AS source_payload_digest, {_sql_plain("payload")} AS body,
  replace({_sql_plain(f"regexp_extract(payload, {_sql_text(warc_derivatives.TITLE)}, 1)")}, chr(10), ' ') AS title,
  list_transform(regexp_extract_all(payload, {_sql_text(warc_derivatives.LINK)}, 1), lambda v: {_sql_link('v')}) AS links FROM source, nl),
fielded AS (SELECT *, array_to_string(list_concat(
    list_transform(string_split(source_headers, nl), lambda h: 'source-header: ' || h),
    ['source-payload-digest: ' || source_payload_digest, 'source-payload-length: ' || strlen(payload), 'title: ' || title],
    list_transform(links, lambda l: 'outlink: ' || l || ' L a/@href')), chr(13) || chr(10)) || nl AS fields FROM parsed),
made AS (SELECT *, {_sql_id("'metadata'", "refers_to", "fields")} AS metadata_id,
  {_sql_id("'conversion'", "refers_to", "body")} AS conversion_id FROM fielded),
records AS (
  SELECT *, 'metadata' AS record_type, metadata_id AS record_id, conversion_id AS concurrent_to,
    'application/warc-fields' AS content_type, fields AS block FROM made
  UNION ALL
  SELECT *, 'conversion', conversion_id, metadata_id, 'text/plain; charset=utf-8', body FROM made)
SELECT page_id, record_type, record_id, concurrent_to, content_type, CAST(strlen(block) AS BIGINT) AS content_length,
  'sha256:' || sha256(block) AS block_digest, block, refers_to, target_uri, '{CAPTURED}' AS date, source_headers,
  source_payload_digest
FROM records
"""


@query
def op2_bfd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bfd_shards.shard(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.find_personal_data(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    counts = [pii_bootstrap.count_of(base, kind).alias(f"n_{kind}") for kind in pii_bootstrap.KINDS]
    return found.select(
        "doc.doc_id",
        *counts,
        F.sha2(pii_bootstrap.written(base), 256).alias("base_sha256"),
        pii_bootstrap.written(F.col("spans")).alias("spans"),
    )


@query
def op4_min_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_slack.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op5_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wu_manber.benchmark_passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    ).withColumn("n_hit", wu_manber.covered())
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        wu_manber.contaminated().alias("contaminated"),
    )


ORACLES["op5_wu_manber_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item_id, w, least(len(w), 13) AS l FROM item_words WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, l, array_to_string(w[i : i + l - 1], ' ') AS p
  FROM sized, LATERAL (SELECT unnest(range(1, len(w) - l + 2)) AS i)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
  FROM doc_words, (SELECT DISTINCT l FROM windows) WHERE len(w) >= l),
found AS (SELECT doc_id, i, x.l AS l, item_id
  FROM (SELECT doc_id, i, l, array_to_string(w[i : i + l - 1], ' ') AS p FROM places) x JOIN windows USING (l, p)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op6_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_simhash_block_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_tables.documents_with_links(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash_tables.written(F.col("code")).alias("fingerprint"),
        simhash_tables.written(F.col("edited_code")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_links",
    )


@query
def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ppm_language.predict(docs, ["doc_id"], ppm_language.learn(docs))
    return found.select(
        "doc.doc_id",
        F.coalesce(ppm_language.remainder("doc.doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "bits_per_byte",
    )


@query
def op9_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(ppm_language.remainder("doc_id", 7) == 2, F.lit(False))
    found = ctw_scores.scores(docs, ~held_out)
    return found.withColumn("held_out", held_out)


@query
def op10_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_chains.shared_passages(table(spark, sf_dir, "documents"))


def _vector_rounds() -> str:
    """Assignments and averages of all rounds, the last assignment by itself."""
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i])))"
    steps = []
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT row, part, entry, {distance} AS d FROM parts JOIN book{k} USING (part)) GROUP BY row, part)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""
mean{k} AS (SELECT part, entry, list(floor_mean ORDER BY i) AS m FROM (
  SELECT part, entry, i, (s - ((s % n) + n) % n) // n AS floor_mean FROM (
    SELECT part, entry, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
    FROM near{k} JOIN parts USING (row, part), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY part, entry, i))
  GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m, e) AS e FROM book{k} LEFT JOIN mean{k} USING (part, entry))""")
    return ",".join(steps)


@query
def op12_walsh_hadamard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, codebooks = vector_codes.encode(table(spark, sf_dir, "embeddings"), ["vec_id", "label"])
    error = F.aggregate("errors", F.lit(0).cast("bigint"), lambda a, b: a + b)
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    rows = stage(found.select("doc.vec_id", "doc.label", code.alias("code"), error.alias("error")), "vector-codes")
    labels = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(codebooks)).alias("codebooks_sha256")
    )


ORACLES["op12_walsh_hadamard_codes"] = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)),
vectors AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row FROM kept),
parts AS MATERIALIZED (SELECT row, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS x
  FROM vectors, LATERAL (SELECT unnest(range(0, 4)) AS part)),
book0 AS (SELECT part, row - 1 AS entry, x AS e FROM parts WHERE row <= 256),{_vector_rounds()},
coded AS (SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{vector_codes.ROUNDS} GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{vector_codes.ROUNDS}) AS codebooks_sha256
FROM vectors JOIN coded USING (row)
"""


@query
def op13_skip_list_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transform(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op13_skip_list_fill_in_middle"] = r"""
WITH named AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS name FROM documents),
drawn AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
  list_transform(range(0, 4), lambda k: CAST('0x' || substr(name, CAST(8 * k + 1 AS INTEGER), 8) AS BIGINT)) AS h FROM named),
ranked AS (SELECT *, len(lines) AS n, least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS a,
  greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
    WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (SELECT *, array_to_string(lines[1 : a], '') AS p, array_to_string(lines[a + 1 : b], '') AS m,
  array_to_string(lines[b + 1 : n], '') AS s FROM ranked)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


@query
def op11_column_wise_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes.without_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    begins = F.filter("spans", lambda x, k: k % 2 == 0)
    ends = F.filter("spans", lambda x, k: k % 2 == 1)
    removed = F.aggregate(F.zip_with(begins, ends, lambda a, b: b - a), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return found.select(
        "doc.doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size(begins).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
