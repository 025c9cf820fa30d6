"""One query per operator on the test tables, with production parameters, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosswalk.llm import codes, language, line_quality, negatives, packing, routed, secrets, segment, sharding, simhash, tool_calls, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_toxicity_chain")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its category probabilities; ``toxic`` documents are the ones to reject."""
    docs = table(spark, folder, "documents")
    chain = toxicity.fit_chain(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, chain).withColumn("kept", ~F.col("toxic"))


@query("op6_word_first_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query("op2_line_labels")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_quality.judge(docs, line_quality.fit(docs, table(spark, folder, "labels")))


@query("op3_virtual_slots")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, folder, "documents"), shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@query("op5_simhash_blocks")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op10_large_item_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op9_columnar_topk",
    """
    WITH e AS (
      SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 5
    """,
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op7_randomness_battery")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"), "n_random")


@query("op8_gumbel_segmentations")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return segment.sample(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), k=2, packed=True)


# Schemas of the tools that turns of the conversations table are read as calls of.
TOOLS = {
    "search": {
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string", "minLength": 20}, "limit": {"type": "integer", "minimum": 1, "maximum": 5}, "urgent": {"type": "boolean"}},
        "additionalProperties": False,
    },
    "configure": {"required": ["prompt", "mode"], "properties": {"prompt": {"type": "string"}, "mode": {"type": "string", "enum": ["long", "short"]}}},
}


@query(
    "op4_tool_calls",
    r"""
    WITH RECURSIVE turns AS (
      SELECT conv_id, turn, role, text, length(text) AS n, 'c' || conv_id || '-' || turn AS call_id FROM conversations
      WHERE conv_id IS NOT NULL AND turn IS NOT NULL
    ), calls AS (
      SELECT *, CASE WHEN role = 'system' THEN 'configure' ELSE 'search' END AS name,
        CASE WHEN role = 'user' AND turn >= 2 AND n < 120 THEN 'c' || conv_id || '-' || (turn - 2) END AS dep
      FROM turns WHERE role IN ('user', 'system')
    ), results AS (
      SELECT conv_id, turn, text, 'c' || conv_id || '-' || (turn - 1) AS call_id FROM turns WHERE role = 'assistant'
    ), levels AS (
      SELECT call_id, 0 AS level FROM calls WHERE dep IS NULL OR dep NOT IN (SELECT call_id FROM calls)
      UNION ALL
      SELECT c.call_id, l.level + 1 FROM calls c JOIN levels l ON c.dep = l.call_id
    ), checked AS (
      SELECT c.*, level, dep IS NOT NULL AND dep NOT IN (SELECT call_id FROM calls) AS lost,
        CASE WHEN name = 'configure' THEN CASE WHEN turn % 2 = 0 AND n % 5 = 0 THEN ['missing mode'] WHEN n % 5 = 1 THEN ['value of mode'] ELSE [] END
          ELSE CASE WHEN n < 20 THEN ['value of query'] ELSE [] END || CASE WHEN n % 7 IN (0, 6) THEN ['value of limit'] ELSE [] END
            || CASE WHEN n % 11 = 0 THEN ['unknown keys size'] ELSE [] END END AS found
      FROM calls c JOIN levels USING (call_id)
    ), joined AS (
      SELECT coalesce(k.conv_id, r.conv_id) AS conv_id, coalesce(k.call_id, r.call_id) AS call_id, coalesce(k.turn, r.turn) AS turn, k.name, k.n, k.text, k.role,
        level, CASE WHEN k.call_id IS NULL THEN [] ELSE found || CASE WHEN lost THEN ['unknown dependency'] ELSE [] END END AS errors,
        k.turn AS call_turn, k.call_id IS NOT NULL AS is_call, r.call_id IS NOT NULL AS has_result, r.text AS result
      FROM checked k FULL JOIN results r ON k.call_id = r.call_id
    ), named AS (
      SELECT *, CASE WHEN NOT is_call THEN 'orphan result' WHEN len(errors) > 0 THEN 'invalid' WHEN NOT has_result THEN 'no result' ELSE 'ok' END AS status,
        CASE WHEN NOT is_call THEN 'null'
          WHEN name = 'configure' THEN '{' || CASE WHEN call_turn % 2 = 0 AND n % 5 = 0 THEN '' WHEN n % 5 = 1 THEN '"mode":"other",' WHEN n > 150 THEN '"mode":"long",' ELSE '"mode":"short",' END || '"prompt":' || to_json(text) || '}'
          ELSE '{"limit":' || (n % 7) || ',"query":' || to_json(text) || CASE WHEN n % 11 = 0 THEN ',"size":' || n ELSE '' END || ',"urgent":' || CASE WHEN text LIKE '%!%' THEN 'true' ELSE 'false' END || '}' END AS arguments
      FROM joined
    )
    SELECT conv_id, call_id, turn, name, status, CAST(level AS BIGINT) AS level, array_to_string(errors, ', ') AS errors,
      CAST(is_call AS BIGINT) AS n_calls, CAST(has_result AS BIGINT) AS n_results,
      '{"arguments":' || arguments || ',"call_id":"' || call_id || '","errors":[' || array_to_string(['"' || e || '"' FOR e IN errors], ',') || '],"level":' || coalesce(level::VARCHAR, 'null')
        || ',"name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(to_json(result)::VARCHAR, 'null') || ',"status":"' || status || '"}' AS json
    FROM named
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """User and system turns are read as calls, an assistant turn as the result of the call one turn before it, and a
    short user turn as depending on the call two turns before it."""
    n = F.length("text")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    name_of = lambda turn: F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), turn)
    mode = F.when((F.col("turn") % 2 == 0) & (n % 5 == 0), F.lit(None)).when(n % 5 == 1, "other").when(n > 150, "long").otherwise("short")
    search = F.to_json(F.struct(F.contains("text", F.lit("!")).alias("urgent"), F.col("text").alias("query"), (n % 7).alias("limit"), F.when(n % 11 == 0, n).alias("size")))
    configure = F.to_json(F.struct(F.col("text").alias("prompt"), mode.alias("mode")))
    is_system = F.col("role") == "system"
    calls = turns.filter(F.col("role").isin("user", "system")).select(
        "conv_id", name_of(F.col("turn")).alias("call_id"), "turn", F.when(is_system, "configure").otherwise("search").alias("name"), F.when(is_system, configure).otherwise(search).alias("arguments"),
        F.when(~is_system & (F.col("turn") >= 2) & (n < 120), F.array(name_of(F.col("turn") - 2))).alias("depends_on"),
    )
    results = turns.filter("role = 'assistant'").select("conv_id", name_of(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return tool_calls.link(calls, results, TOOLS)


@query(
    "op11_packed_negatives",
    """
    WITH e AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
      FROM e a JOIN e c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
    ), p AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank FROM s WHERE same)
      WHERE positive_rank <= 5
    ), n AS (
      SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, positive_rank,
        row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score, CAST(positive_rank AS INTEGER) AS positive_rank
    FROM n WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds of codebook training as one statement: a distance to every entry, then the mean of each entry's parts."""
    distance = "(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
          SELECT row, part, v, entry, d FROM (
            SELECT p.row, p.part, p.v, b.entry, {distance} AS d, row_number() OVER (PARTITION BY p.row, p.part ORDER BY {distance}, b.entry) AS place
            FROM p JOIN b{r} b ON p.part = b.part) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
              SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
                SELECT part, entry, list(floor(total / n) ORDER BY i) AS v FROM (
                  SELECT part, entry, i, sum(v[i]) AS total, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 1000)) AS i) WHERE i <= len(v) GROUP BY part, entry, i)
                GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
    WITH e AS MATERIALIZED (
      SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row
      FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), p AS MATERIALIZED (
      SELECT row, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS v FROM e, (SELECT unnest(range({parts})) AS part)
    ), b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, v FROM p WHERE row <= {entries}),
    {", ".join(steps)},
    coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
    books AS (SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN v], ','), ',' ORDER BY part, entry)) AS digest FROM b{rounds}),
    sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN e USING (row) GROUP BY label)
    SELECT vec_id, code, error, label_error, digest AS codebooks_sha256
    FROM coded JOIN e USING (row) JOIN sums ON e.label IS NOT DISTINCT FROM sums.label, books
    """


@query("op12_walsh_codes", codes_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compress(table(spark, folder, "embeddings"))


@query("op13_learned_partitions")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return routed.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
