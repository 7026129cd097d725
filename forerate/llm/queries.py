"""The operators over the text tables, by name; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forerate.functions.ordering import running_sums
from forerate.llm import (
    bpe,
    centroids,
    decontaminate,
    fill_middle,
    ngram_join,
    piece_counts,
    pieces,
    quality,
    slots,
    substrings,
    token_files,
    tool_calls,
    url_filter,
)
from forerate.sources.staging import staged

SHARDS = 40
RULES = (
    url_filter.Rule(False, "net", "/"),
    url_filter.Rule(True, "example.net", "/en/"),
    url_filter.Rule(False, "example.com", "/de/"),
    url_filter.Rule(True, "org", "/fr/"),
)
TOOLS = (
    tool_calls.Tool(
        "search",
        (tool_calls.Param("query", "string", high=200), tool_calls.Param("limit", "integer", low=1, high=120)),
    ),
    tool_calls.Tool(
        "count",
        (
            tool_calls.Param("query", "string", low=12),
            tool_calls.Param("limit", "integer", required=False, high=200),
            tool_calls.Param("exact", "boolean", required=False),
        ),
    ),
    tool_calls.Tool("translate", (tool_calls.Param("query", "string"), tool_calls.Param("target", "string"))),
)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.token_table(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return token_files.token_digest(spark, path)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_found").alias("n_found"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), RULES)


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.encode(docs, vocabulary("piece_bpe_32k.model"), verified="round_trip")
    return rows.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "round_trip")


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with ``conv`` (never null, and no other conversation's), ``number`` of a call in its conversation, and the number a result ``answers``."""
    turns = turns.withColumn("conv", F.to_json(F.array(F.col("conv_id").cast("string"))))
    has = lambda role: F.coalesce(F.max((F.col("role") == role).cast("int")), F.lit(0))
    places = turns.where("turn is not null").groupBy("conv", "turn").agg(has("assistant").alias("calls"), has("user").alias("users"))
    places = running_sums(places, ["conv"], [("turn", True)], ["calls"]).select("conv", "turn", "users", "calls_before")
    places = staged(places, "places")
    first = places.where("users > 0 and calls_before > 0").groupBy("conv", "calls_before").agg(F.min("turn").alias("turn"))
    places = places.select("conv", "turn", F.col("calls_before").alias("at"))
    out = turns.join(places, ["conv", "turn"], "left").join(first, ["conv", "turn"], "left")
    return out.withColumns(
        {
            "number": F.when(F.col("role") == "assistant", F.col("at")),
            "answers": F.when(F.col("role") == "user", F.col("calls_before") - 1),
        }
    ).drop("at", "calls_before")


def calls_and_results(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tool calls, results and other turns as told by the turns of ordinary conversations.

    Each assistant turn is a call: its tool by the turn's number, its arguments from the whole text. The
    k-th of a conversation, from 0 and in order of turn, uses the result of call (k - 1) div 2. The first
    user turn after a call and before the next is the call's result. System and first user turns, and
    whatever else is no call or result, are the other turns.
    """
    turns = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    ident = lambda turn: F.concat(F.lit("c"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit("-"), turn.cast("string"))
    turn = F.col("turn")
    k = F.floor(turn / 2)
    tool = F.element_at(F.array(F.lit("search"), F.lit("count"), F.lit("translate")), (k % 3 + 1).cast("int"))
    query, n = F.col("text"), F.char_length("text")
    arguments = (
        F.when(k % 3 == 0, F.to_json(F.struct(query.alias("query"), F.floor(n / 10).alias("limit"))))
        .when(k % 3 == 1, F.to_json(F.struct(query.alias("query"), (n > 300).alias("exact"))))
        .otherwise(F.to_json(F.struct(query.alias("target"), F.when(n < 900, query).alias("query"))))
    )
    turns = staged(numbered(turns), "turns")
    numbers = turns.where("number is not null").select("conv", "number", ident(turn).alias("id")).distinct()
    calls = turns.where("number is not null").select(
        *("conv_id", "turn", "conv", ident(turn).alias("call_id"), tool.alias("name"), arguments.alias("arguments")),
        F.when(F.col("number") > 0, F.expr("(number - 1) div 2")).alias("uses"),
    )
    used = numbers.select("conv", F.col("number").alias("uses"), F.col("id").alias("need"))
    need = F.when(F.col("need").isNotNull(), F.array("need")).otherwise(F.array().cast("array<string>"))
    calls = calls.join(used, ["conv", "uses"], "left")
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", need.alias("needs"))
    results = turns.where("answers is not null").select("conv_id", "turn", "conv", F.col("answers").alias("number"), F.col("text").alias("content"))
    results = results.join(numbers, ["conv", "number"]).select("conv_id", "turn", F.col("id").alias("call_id"), "content")
    others = turns.where("number is null and answers is null").select("conv_id", "turn", "role", "text")
    return calls, results, others


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, others = calls_and_results(table(spark, sf_dir, "conversations"))
    return tool_calls.linked(calls, results, TOOLS).unionByName(tool_calls.plain(others))


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = slots.shard(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_digest(table(spark, sf_dir, "documents"))


def op10_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, continuations = piece_counts.pieces_of_model(vocabulary("piece_bpe_32k.model"))
    return piece_counts.count_pieces(table(spark, sf_dir, "documents"), starts, continuations)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encode(docs, vocabulary("word_bpe_49k.json"), decoded="decoded")
    return rows.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("tokens").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        *("doc_id", "n", "form", "prefix_chars", "middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored("output", "form"), 256).alias("restored_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.clusters(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_ngram_join,
        op3_decontamination,
        op4_url_filter,
        op5_sentence_pieces,
        op6_line_frequency,
        op7_tool_calls,
        op8_virtual_slots,
        op9_substring_dedup,
        op10_piece_counts,
        op11_bpe,
        op12_fill_middle,
        op13_centroids,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def lloyd_sql(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    """SQL of plain Lloyd's rounds on integer vectors, one table of centroids and one of assignments a round."""
    parts = [
        f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS j, x FROM v
  ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, x, m.j AS j, m.d AS d FROM (
  SELECT v.vec_id, any_value(v.x) AS x, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'j': c.j}}) AS m
  FROM v, c{i} c GROUP BY v.vec_id))"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM (
    SELECT j, i, sum(e)::HUGEINT AS s, count(*) AS n FROM (SELECT j, unnest(x) AS e, unnest(range(1, {dims + 1})) AS i FROM a{i}) GROUP BY 1, 2)
  GROUP BY 1) m USING (j))"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, a.j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.j = a.j"""


ORACLES: dict[str, str] = {
    "op2_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 90 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) c USING (doc_id)""",
    "op3_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[j:j + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS j FROM d)),
its AS (SELECT DISTINCT item_id, array_to_string(w[j:j + 4], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS j FROM i)),
n AS (SELECT item_id, count(*) AS n_shingles FROM its GROUP BY 1)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found FROM ds JOIN its USING (g) JOIN n USING (item_id)
GROUP BY 1, 2, 3 HAVING 10 * count(*) >= 8 * n_shingles""",
    "op9_substring_dedup": rf"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
p AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS m FROM p GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + j AS k FROM (SELECT p.doc_id, p.i, unnest(generate_series(0, 49)) AS j FROM p JOIN f USING (g) WHERE f.m < p.doc_id)),
g AS (SELECT doc_id, count(*) AS n, list(k) AS ks FROM gone GROUP BY 1)
SELECT w.doc_id, len(w) AS n_words, coalesce(g.n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN g.n IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(g.ks, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)""",
    "op12_fill_middle": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
k AS (SELECT doc_id, t, n, ('0x' || h[1:8])::UBIGINT % (n + 1) AS a, ('0x' || h[9:16])::UBIGINT % (n + 1) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::UBIGINT % 100 >= 90 THEN 'plain'
    WHEN ('0x' || h[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT *, least(a, b)::BIGINT AS p, greatest(a, b)::BIGINT AS q FROM k),
s AS (SELECT *, substring(t, 1, p) AS x, substring(t, p + 1, q - p) AS m, substring(t, q + 1) AS y FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || y || '<M>' || m ELSE '<S>' || y || '<P>' || x || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM s""",
    "op13_centroids": lloyd_sql(8, 10, 64, 1024, 3),
}
