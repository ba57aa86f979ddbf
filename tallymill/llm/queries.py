"""Every operator as a query over its whole table, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.llm import langid, lattice, mixing, packing, passages, pii, repeats, resampling, simhash, token_count, topk, trie_codes, vafile
from tallymill.plans.tables import load
from tallymill.session import written_table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 512
#: The queries' key; whoever uses the operator brings a secret one.
PSEUDONYM_KEY = b"key of the test queries"


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_count.token_counts(load(spark, folder, "documents"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    replaced = pii.pseudonymise(F.col("text"), PSEUDONYM_KEY).alias("p")
    rows = load(spark, folder, "documents").select("doc_id", replaced)
    kinds = [F.size(F.filter("p.found.kind", lambda k: k == F.lit(kind))).alias(f"n_{kind}") for kind in pii.KINDS]
    return rows.select("doc_id", "p.text", F.size("p.found").alias("n_found"), *kinds)


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(load(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.begin)
    spans = F.size("spans").cast("long")
    digest, text = F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), spans.alias("n_spans"), digest, F.octet_length("kept").cast("long").alias("n_kept"), text)


def op5_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(load(spark, folder, "embeddings"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(load(spark, folder, "documents"), WORD_BPE, keep_ids=False).drop("ids")


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(load(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.Mix(load(spark, folder, "documents"))
    return mix.taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "first_slot", "n_slots")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    held = langid.held_out(F.col("doc_id"))
    learned = langid.fit(docs.where(~held))
    rows = docs.select("doc_id", held.alias("held_out"), langid.identify(F.col("text"), learned).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def op10_resampling(spark: SparkSession, folder: str) -> DataFrame:
    good = load(spark, folder, "labels").where("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id"))
    return resampling.resample(load(spark, folder, "documents"), good)


def op11_passages(spark: SparkSession, folder: str) -> DataFrame:
    cut = passages.remove_passages(load(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.col("text").cast("string").alias("text"))


def op12_trie_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, codebooks = trie_codes.vector_codes(load(spark, folder, "embeddings"), keep=["label"])
    digits = F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    coded = written_table(coded.select("row.vec_id", "row.label", digits.alias("code"), "error"), "codes")
    by_label = coded.groupBy(F.col("label").alias("same")).agg(F.try_sum("error").alias("label_error"))
    components = ",".join(str(v) for entries in codebooks for entry in entries.tolist() for v in entry)
    rows = coded.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select("vec_id", "code", "error", "label_error")
    return rows.withColumn("codebooks_sha256", F.lit(sha256(components.encode()).hexdigest()))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    clustered, centroids = vafile.cluster(load(spark, folder, "embeddings"))
    hashes = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = F.get(F.array(*[F.lit(h) for h in hashes]).cast("array<string>"), F.col("cluster"))
    return vafile.with_inertia(clustered).withColumn("centroid_sha256", own)


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_token_counts,
    op2_simhash_groups,
    op3_pseudonyms,
    op4_repeats,
    op5_near_vectors,
    op6_packing,
    op7_top_k,
    op8_mixing,
    op9_language,
    op10_resampling,
    op11_passages,
    op12_trie_codes,
    op13_centroids,
]

_FINITE = "len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"


def _whole(scale: int) -> str:
    return f"[CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]"


def _apart(size: int) -> str:
    return f"CAST(list_sum([(a.x[i] - b.x[i]) * (a.x[i] - b.x[i]) FOR i IN range(1, {size + 1})]) AS BIGINT)"


#: Floor of s / n for whole numbers.
_MEAN = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


def _codes_sql(parts: int = 4, size: int = 16, entries: int = 256, rounds: int = 4) -> str:
    """Codebooks round by round; the size of the vectors is that of the test table."""
    steps = [
        f"""v AS (SELECT row_number() OVER () AS r, vec_id, label, {_whole(1024)} AS x FROM embeddings WHERE {_FINITE}),
        p AS (SELECT r, q, x[{size} * q + 1:{size} * q + {size}] AS x FROM v, (SELECT unnest(range({parts})) AS q)),
        d AS (SELECT q, x, count(*) AS n FROM p GROUP BY ALL),
        o AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS e FROM v),
        b0 AS (SELECT q, e, x FROM p JOIN o USING (r) WHERE e < {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS (SELECT a.q, a.x, any_value(a.n) AS n, min([{_apart(size)}, b.e]) AS m
            FROM d a JOIN b{i} b USING (q) GROUP BY a.q, a.x)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (SELECT q, m[2] AS e, k, CAST(sum(n * x[k]) AS BIGINT) AS s, CAST(sum(n) AS BIGINT) AS n
                FROM a{i}, (SELECT unnest(range(1, {size + 1})) AS k) GROUP BY ALL),
            u{i} AS (SELECT q, e, list({_MEAN} ORDER BY k) AS x FROM s{i} GROUP BY q, e),
            b{i + 1} AS (SELECT q, e, coalesce(u.x, b.x) AS x FROM b{i} b LEFT JOIN u{i} u USING (q, e))"""
            )
    return f"""
        WITH {", ".join(steps)},
        c AS (SELECT r, string_agg(printf('%02x', m[2]), '' ORDER BY q) AS code, CAST(sum(m[1]) AS BIGINT) AS error
              FROM p JOIN a{rounds} USING (q, x) GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY q, e)) FROM b{rounds}) AS codebooks_sha256
        FROM v JOIN c USING (r)"""


def _centroids_sql(size: int = 64, k: int = 16, rounds: int = 3) -> str:
    steps = [
        f"""v AS (SELECT row_number() OVER () AS r, vec_id, {_whole(64)} AS x FROM embeddings WHERE len(embedding) = {size} AND {_FINITE}),
        b0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS e, x FROM v QUALIFY e < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS (SELECT a.r, any_value(a.vec_id) AS vec_id, any_value(a.x) AS x, min([{_apart(size)}, b.e]) AS m FROM v a, b{i} b GROUP BY a.r)")
        if i < rounds:
            steps.append(
                f"""s{i} AS (SELECT m[2] AS e, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
                FROM a{i}, (SELECT unnest(range(1, {size + 1})) AS k) GROUP BY ALL),
            u{i} AS (SELECT e, list({_MEAN} ORDER BY k) AS x FROM s{i} GROUP BY e),
            b{i + 1} AS (SELECT e, coalesce(u.x, b.x) AS x FROM b{i} b LEFT JOIN u{i} u USING (e))"""
            )
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, CAST(m[2] AS INTEGER) AS cluster, m[1] AS distance, CAST(sum(m[1]) OVER (PARTITION BY m[2]) AS BIGINT) AS cluster_inertia,
               CAST(sum(m[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(b.x, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN b{rounds} b ON m[2] = e"""


ORACLE_SQL = {
    "op11_passages": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        s AS (SELECT r, i, word, string_agg(word, ' ') OVER a AS s, count(*) OVER a AS c
              FROM t WINDOW a AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
        again AS (SELECT s FROM s WHERE c = 35 GROUP BY s HAVING count(*) > 1),
        g AS (SELECT r, i, word, max(CASE WHEN c = 35 AND again.s IS NOT NULL THEN 1 ELSE 0 END)
                       OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
              FROM s LEFT JOIN again USING (s)),
        k AS (SELECT r, sum(gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM g GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
               CASE WHEN n > 0 THEN coalesce(kept, '') ELSE coalesce(text, '') END AS text
        FROM d LEFT JOIN k USING (r)""",
    "op12_trie_codes": _codes_sql(),
    "op13_centroids": _centroids_sql(),
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([q.x[i] * c.x[i] FOR i IN range(1, len(q.x) + 1)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                   md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
                     2.0::DOUBLE * source_size AS most FROM s),
        p AS (SELECT *, coalesce(sum(most) OVER a, 0) AS stopped, sum(weight) OVER b AS rest,
                     1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total
              FROM w
              WINDOW a AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                     b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        l AS (SELECT *, (total - stopped) / rest AS level FROM p),
        t AS (SELECT source, source_size,
                     CASE WHEN most / weight <= level THEN most
                          ELSE weight * max(CASE WHEN most / weight > level THEN level END) OVER () END AS target
              FROM l),
        c AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
                     sum(d.size) OVER (PARTITION BY t.source ORDER BY d.o, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS pos
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        n AS (SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS sid, target FROM t),
        g AS (SELECT *, CAST(ceil(floor(target) / 64) AS BIGINT) AS blocks, sum(target) OVER (ORDER BY sid) / sum(target) OVER () AS upper,
                     lead(sid) OVER (ORDER BY sid) IS NULL AS final
              FROM n WHERE target >= 1),
        h AS (SELECT *, CASE WHEN final THEN 1.0 ELSE upper END AS high, coalesce(lag(upper) OVER (ORDER BY sid), 0.0) AS low FROM g),
        j AS (SELECT slot, ((slot + 1) * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE AS point
              FROM (SELECT unnest(range(0, coalesce((SELECT CAST(sum(blocks) AS BIGINT) FROM g), 0))) AS slot)),
        m AS (SELECT slot, source, sid, blocks, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM j JOIN h ON point >= low AND point < high),
        z AS (SELECT h.source, h.sid, unnest(range(coalesce(got, 0), blocks)) AS rank
              FROM h LEFT JOIN (SELECT sid, count(*) AS got FROM m GROUP BY sid) USING (sid)),
        o AS (SELECT source, rank, slot FROM m WHERE rank < blocks
              UNION ALL SELECT source, rank, (SELECT count(*) FROM j) + row_number() OVER (ORDER BY sid, rank) - 1 FROM z),
        y AS (SELECT row_number() OVER () AS r, * FROM c),
        k AS (SELECT r, source, turn * source_size + pos AS low, least(turn * source_size + pos + size, floor(target)) AS high
              FROM y, (SELECT unnest([0, 1]) AS turn)),
        q AS (SELECT r, min(slot) AS first_slot, count(*) AS n_slots
              FROM (SELECT r, source, unnest(range(CAST(floor(low / 64) AS BIGINT), CAST(floor((high - 1) / 64) AS BIGINT) + 1)) AS rank FROM k WHERE high > low) x
              JOIN o ON x.rank = o.rank AND x.source IS NOT DISTINCT FROM o.source GROUP BY r)
        SELECT doc_id, size, source_size, target,
               CAST(greatest(0, least(pos + size, floor(target)) - pos)
                    + greatest(0, least(source_size + pos + size, floor(target)) - source_size - pos) AS BIGINT) AS taken,
               first_slot, coalesce(n_slots, 0) AS n_slots
        FROM y LEFT JOIN q USING (r)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
