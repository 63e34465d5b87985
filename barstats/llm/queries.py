"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstats.llm import (
    byte_bpe,
    centroids,
    decontamination,
    licenses,
    line_spread,
    mixing,
    quality,
    ranked_search,
    secrets,
    simhash,
    surrogates,
    token_counts,
    token_store,
)
from barstats.llm.common import WORD
from barstats.sources.scratch import new_folder

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
#: For trying things out; a corpus of its own has a key of its own.
PII_KEY = "example key"


def table(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the benchmark items it leaks, and how much of the worst."""
    judged = decontamination.judge(table(spark, folder).select("doc_id", "text"), table(spark, folder, "benchmark"))
    leaks = F.filter("overlaps", lambda o: o["leaked"])
    return judged.select(
        "doc_id",
        "leaked",
        F.size("overlaps").cast("long").alias("n_overlaps"),
        F.coalesce(F.array_max(F.transform("overlaps", lambda o: o["share"])), F.lit(0.0)).alias("share"),
        F.array_sort(F.transform(leaks, lambda o: o["item_id"])).alias("item_ids"),
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Repositories are the documents, owners their sources."""
    found = secrets.judge_candidates(table(spark, folder))
    listed = "array_join(transform({0}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    count = "cast(size(filter(candidates, x -> {0})) as bigint)"
    return found.select(
        "doc_id",
        *(F.expr(count.format(f"x.kind = '{k}'")).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(F.expr(listed.format("filter(candidates, x -> x.kind <> 'key')")), 256).alias("base_sha256"),
        F.expr(listed.format("candidates")).alias("spans"),
        *(F.expr(count.format(f"x.verdict = '{v}'")).alias(f"n_{v}") for v in ("live", "example", "unclear")),
    )


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder).select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(WORD_TOKENIZER))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document, with the shard of each copy and its place there."""
    plan = mixing.with_positions(mixing.plan_mix(table(spark, folder)))
    taken = F.col("size") * F.size("copies")
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        F.transform("copies", lambda c: c["shard"]).alias("shards"),
        F.transform("copies", lambda c: c["position"]).alias("positions"),
    )


def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every text with its personal data replaced, and how much of each kind was."""
    docs = table(spark, folder).select("doc_id", "text")
    out = surrogates.replace_entities(docs, PII_KEY)
    count = "cast(size(filter(replaced, x -> x.kind = '{0}')) as bigint) AS n_{0}"
    return out.select("doc_id", "text", *(F.expr(count.format(k)) for k in surrogates.KINDS))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder).select("doc_id", "text"))
    return judged.select("doc_id", *quality.FEATURES, "base_failed", "kept", F.round("posterior", 6).alias("posterior"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    templates = spark.createDataFrame(licenses.TEMPLATES + licenses.OTHERS, "label string, text string")
    found = licenses.scan(table(spark, folder).select("doc_id", "text"), templates)
    base = "transform(phrases, x -> x.label)"
    every = f"concat({base}, transform(blocks, x -> x.label))"
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.expr("array_min(transform(phrases, x -> x.word))").alias("first_word"),
        F.expr("array_max(transform(phrases, x -> x.word))").alias("last_word"),
        F.expr(f"array_join(array_sort(array_distinct({base})), ',')").alias("base_labels"),
        F.expr(f"array_join(array_sort(array_distinct({every})), ',')").alias("labels"),
        F.expr(
            "CASE WHEN size(phrases) > 0 THEN 1D ELSE coalesce(array_max(transform(blocks, x -> x.score)), 0D) END"
        ).alias("score"),
    )


def op8_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder).select("doc_id", "text", "source")
    return line_spread.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder))
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op10_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder)
    store = token_store.write_store(
        docs, new_folder(spark, "token-store"), public_tokenizers.path(BYTE_TOKENIZER)
    )
    keys = store.directory.select("doc_id", "copy")
    read = store.read(keys, "ids_crc32 long", token_store.crc32_of)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents for every item of the benchmark."""
    index = ranked_search.build_index(table(spark, folder), new_folder(spark, "index"))
    return ranked_search.search(index, table(spark, folder, "benchmark"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder).select("doc_id", "text")
    path, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(docs, path, pattern).select("doc_id", "ids")
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return byte_bpe.decode(encoded, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.with_inertia(centroids.cluster(table(spark, folder, "embeddings")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_secret_scan,
        op3_token_counts,
        op4_mixing,
        op5_surrogates,
        op6_quality,
        op7_license_scan,
        op8_line_spread,
        op9_simhash,
        op10_token_store,
        op11_ranked_search,
        op12_byte_bpe,
        op13_centroids,
    )
}



def _clusters_sql(k: int, rounds: int) -> str:
    """Rounds of assignment and means, one behind the other."""
    near = """near{i} AS MATERIALIZED (
            SELECT id, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
                SELECT v.id, c.k, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d
                FROM parts v JOIN centroids{i} c USING (place) GROUP BY v.id, c.k
            ) GROUP BY id
        )"""
    mean = """centroids{j} AS MATERIALIZED (
            SELECT c.k, c.place, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x)::BIGINT AS x
            FROM centroids{i} c LEFT JOIN (
                SELECT near{i}.k, v.place, sum(v.x)::HUGEINT AS s, count(*)::HUGEINT AS n
                FROM near{i} JOIN parts v USING (id) GROUP BY near{i}.k, v.place
            ) m USING (k, place)
        )"""
    steps = [part.format(i=i, j=i + 1) for i in range(rounds) for part in (near, mean)]
    steps.append(near.format(i=rounds))
    return f"""
        WITH kept AS (
            SELECT vec_id, row_number() OVER () AS id, embedding FROM embeddings
            WHERE len(embedding) = {centroids.COMPONENTS}
                AND (SELECT count(*) FROM (SELECT unnest(embedding) AS x) WHERE isfinite(x)) = {centroids.COMPONENTS}
        ), parts AS MATERIALIZED (
            SELECT id, generate_subscripts(embedding, 1) AS place,
                floor({centroids.SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept
        ), first AS (
            SELECT id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM kept
            QUALIFY k < {k}
        ), centroids0 AS MATERIALIZED (
            SELECT first.k, parts.place, parts.x FROM first JOIN parts USING (id)
        ), {", ".join(steps)}, sums AS (
            SELECT k, sum(d)::BIGINT AS cluster_inertia FROM near{rounds} GROUP BY k
        ), names AS (
            SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256
            FROM centroids{rounds} GROUP BY k
        )
        SELECT vec_id, k::INTEGER AS cluster, d AS distance, cluster_inertia,
            (SELECT sum(cluster_inertia)::BIGINT FROM sums) AS inertia, centroid_sha256
        FROM near{rounds} JOIN kept USING (id) JOIN sums USING (k) JOIN names USING (k)
    """


#: The others go through a tokenizer, positions of matches, iterations or keyed hashes.
ORACLE = {
    "op8_line_spread": f"""
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) AS no
            FROM documents
        ), wide AS (
            SELECT line FROM lines WHERE regexp_matches(line, '{WORD}')
            GROUP BY line HAVING count(DISTINCT coalesce('s' || source, '')) >= {line_spread.MIN_SITES}
        ), marked AS (
            SELECT lines.*, wide.line IS NOT NULL AS gone FROM lines LEFT JOIN wide ON lines.line = wide.line
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text
        FROM marked GROUP BY doc_id
    """,
    "op11_ranked_search": f"""
        WITH terms AS (
            SELECT row, doc_id, term, count(*) AS tf FROM (
                SELECT rowid AS row, doc_id, unnest(regexp_extract_all(
                    translate(text, '{ranked_search.UPPER}', '{ranked_search.LOWER}'), '{ranked_search.TERM}')) AS term
                FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
            ) GROUP BY row, doc_id, term
        ), lengths AS (SELECT row, sum(tf) AS n FROM terms GROUP BY row
        ), total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM lengths
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM terms, total GROUP BY term, docs
        ), asked AS (
            SELECT item, item_id, unnest(regexp_extract_all(
                translate(text, '{ranked_search.UPPER}', '{ranked_search.LOWER}'), '{ranked_search.TERM}')) AS term
            FROM (SELECT row_number() OVER () AS item, * FROM benchmark)
        ), scored AS (
            SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (
                1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // all_terms)))))::BIGINT AS score
            FROM asked JOIN terms USING (term) JOIN weights USING (term) JOIN lengths USING (row), total
            GROUP BY item, item_id, row, doc_id
        )
        SELECT item_id, row_number() OVER best AS rank, doc_id, score FROM scored WHERE score > 0
        WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id)
        QUALIFY rank <= 20
    """,
    "op13_centroids": _clusters_sql(centroids.CENTROIDS, centroids.ROUNDS),
}
