"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import chat, exact, fixity, jaccard, licenses, manifest, mixing, neighbours, packing, quality, repeats, toxicity, trie
from cadence.llm.tables import held_out, read, stage


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), n=3, percent=90)


def replica(pages: DataFrame) -> DataFrame:
    """A copy of the pages as a faulty disk might give it back: changed, lost and foreign records."""
    kept = pages.filter(F.coalesce(F.pmod("page_id", F.lit(101)) != 7, F.lit(True)))
    hurt = F.when(F.pmod("page_id", F.lit(97)) == 13, F.concat(F.coalesce("html", F.lit("")), F.lit("\x00"))).otherwise(F.col("html"))
    foreign = pages.filter(F.pmod("page_id", F.lit(103)) == 5).withColumn("page_id", -F.col("page_id") - 1)
    return kept.withColumn("html", hurt).unionByName(foreign)


def op2_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    own, found = fixity.audit(pages, replica(pages))
    found = found.select(F.col("key").alias("f_"), "offset", "status")
    rows = own.join(found, F.col("key").eqNullSafe(F.col("f_")), "full")
    return rows.select(F.coalesce("key", "f_").alias("page_id"), F.coalesce("records", F.lit(0).cast("long")).alias("n_records"), F.coalesce("bytes", F.lit(0).cast("long")).alias("n_bytes"), F.coalesce("status", F.lit("ok")).alias("status"), F.when(F.col("status") != "extra", F.col("offset")).alias("record_offset"))


OP2_SQL = r"""
WITH r AS (
  SELECT page_id, strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'Content-Length: '
    || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)) + strlen(coalesce(html, '')) + 4 AS b
  FROM pages),
p AS (
  SELECT page_id, count(*) AS n_records, CAST(sum(b) AS BIGINT) AS n_bytes,
    CAST(coalesce(sum(sum(b)) OVER (ORDER BY page_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o
  FROM r GROUP BY page_id)
SELECT page_id, n_records, n_bytes,
  CASE WHEN page_id % 101 = 7 THEN 'missing' WHEN page_id % 97 = 13 THEN 'changed' ELSE 'ok' END AS status,
  CASE WHEN page_id % 101 = 7 OR page_id % 97 = 13 THEN o END AS record_offset
FROM p
UNION ALL SELECT -page_id - 1, 0, 0, 'extra', NULL FROM p WHERE page_id % 103 = 5
"""


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed, rest = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    changed = changed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return changed.unionByName(rest.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256"))


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_dedup(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP4_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")), quality.THRESHOLD)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")), toxicity.THRESHOLD)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


#: The conversation that the formatted table gets besides its own: texts that are control strings.
CONFLICT = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(CONFLICT, "conv_id long, turn long, role string, text string"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        now: list | None = None

        def done(x: list) -> dict:
            return {"conv_id": x[0], "n_turns": x[1], "turns_sha256": x[2].hexdigest(), "loss_chars": x[3], "loss_sha256": x[4].hexdigest(), "formatted_chars": x[5]}

        for batch in batches:
            out = []
            for part in batch.to_pylist():
                if part["part"] == 0:
                    out += [done(now)] if now else []
                    now = [part["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in chat.parse(part["text"]):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for m in part["mask"]:
                    text = chat.unescape(part["text"][m["start"] : m["end"]])
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(part["text"])
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if now:
            yield pa.RecordBatch.from_pylist([done(now)], schema=schema)

    return chat.format_conversations(rows).mapInArrow(digest, _DIGEST)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.curriculum(mixing.plan_mix(read(spark, sf_dir, "documents")))
    return mix.select("doc_id", "size", "source_size", "target", (F.size("times") * F.col("size")).cast("long").alias("taken"), "times")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = neighbours.Graph(read(spark, sf_dir, "embeddings"))
    return graph.search(graph.rows.filter("vec_id % 20 = 0").select("vec_id", "vec"), 20, id="vec_id")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, with the text of every fifth document tampered with: A-Z in lower case."""
    rows = manifest.manifest(read(spark, sf_dir, "documents"), F.translate("text", UPPER, UPPER.lower()), F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    return rows.withColumnRenamed("proof", "proof_sha256").withColumn("verified", F.col("folded_root") == F.col("root"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _crc32_sql(column: str) -> str:
    """crc32 of the decimal digits of a column, bit by bit."""
    digits = f"list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    bit = "lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    return f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || {digits}, lambda c, b: list_reduce([xor(c, b)] || [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0], {bit})))"


def _op11_sql(levels: int = 6, upper: int = 4) -> str:
    """Level by level: nodes, what stands beside each, and the fold of every leaf; for up to 16 ** levels rows a source."""

    def leaf(text: str) -> str:
        fields = (f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text))
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    def climb(name: str, key: str, levels: int) -> list[str]:
        out = []
        for k in range(levels):
            run = f"PARTITION BY {key}, pos // 16 ORDER BY pos ROWS BETWEEN"
            out.append(f"{name}p{k} AS (SELECT {key}, pos, d, count(*) OVER (PARTITION BY {key}) AS n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})")
            out.append(f"{name}{k + 1} AS (SELECT {key}, pos // 16 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d FROM {name}p{k} WHERE n > 1 GROUP BY {key}, pos // 16)")
        tops = " UNION ALL ".join(f"SELECT {key}, d FROM {name}p{k} WHERE n = 1" for k in range(levels))
        return [*out, f"{name}r AS ({tops})"]

    parts = [
        f"t AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf('text')} AS leaf, CASE WHEN {_crc32_sql('doc_id')} % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS other FROM documents)",
        "h AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM t)",
        "a0 AS (SELECT g, pos, leaf AS d FROM h)", *climb("a", "g", levels),
        "s AS (SELECT g, d, 0 AS o, row_number() OVER (ORDER BY g) - 1 AS pos FROM ar)", "b0 AS (SELECT o, pos, d FROM s)", *climb("b", "o", upper),
        "f0 AS (SELECT h.doc_id, h.g, h.leaf, h.pos, coalesce(h.other, h.leaf) AS f, '' AS proof FROM h)",
    ]
    step = "CASE WHEN p.n > 1 THEN sha256(p.l || f.f || p.r) ELSE f.f END AS f, f.proof || CASE WHEN p.n > 1 THEN p.l || p.r ELSE '' END AS proof"
    for k in range(levels):
        parts.append(f"f{k + 1} AS (SELECT f.doc_id, f.g, f.leaf, f.pos // 16 AS pos, {step} FROM f{k} f LEFT JOIN ap{k} p ON p.g = f.g AND p.pos = f.pos)")
    parts.append(f"e0 AS (SELECT f.doc_id, f.leaf, s.d AS subroot, s.pos, f.f, f.proof FROM f{levels} f JOIN s ON s.g = f.g)")
    for k in range(upper):
        parts.append(f"e{k + 1} AS (SELECT f.doc_id, f.leaf, f.subroot, f.pos // 16 AS pos, {step} FROM e{k} f LEFT JOIN bp{k} p ON p.pos = f.pos)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT e.doc_id, e.leaf, e.subroot, r.d AS root, sha256(e.proof) AS proof_sha256, e.f AS folded_root, e.f = r.d AS verified FROM e{upper} e, br r"


OP11_SQL = _op11_sql()


def shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, item) and conv_id of all conversations, rebuilt to share beginnings: the first h turns of conversation c - c % 5, then c's own without its first h."""
    block = F.shiftright("pos", 16).alias("block")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    counts = stage(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "counts")
    donors = counts.select(F.col("conv_id").alias("donor"), F.col("n").alias("n_donor"))
    convs = counts.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("donor")).join(donors, "donor", "left")
    convs = stage(convs.withColumn("taken", F.least("h", F.coalesce("n_donor", F.lit(0)))).select("conv_id", "h", "donor", "taken"), "convs")
    start = turns.filter("pos <= 8").select(F.col("conv_id").alias("donor"), "pos", "item")
    start = convs.filter("taken > 0").join(start, "donor").filter("pos <= taken").select("conv_id", F.col("pos").alias("depth"), "item")
    # a long conversation meets its own row block by block
    own = turns.filter(F.col("pos") > h).select("conv_id", "pos", "item", block)
    blocks = own.select("conv_id", "block").distinct().join(convs, "conv_id")
    own = own.join(blocks, ["conv_id", "block"]).select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "item")
    return start.unionByName(own), convs.select("conv_id")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(trie.turns(read(spark, sf_dir, "conversations")), "turns")
    return trie.prefix_trie(*shared_starts(turns))


OP12_SQL = f"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n, {_crc32_sql('conv_id')} % 9 AS h, conv_id - conv_id % 5 AS donor FROM o GROUP BY conv_id),
c AS (SELECT n.conv_id, n.h, n.donor, least(n.h, coalesce(d.n, 0)) AS k FROM n LEFT JOIN n d ON d.conv_id = n.donor),
r AS (
  SELECT c.conv_id, o.pos AS depth, role, text FROM c JOIN o ON o.conv_id = c.donor AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, o.pos - c.h + c.k, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
p AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
    sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS path
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM p GROUP BY depth, path),
up AS (
  SELECT v.*, w.path AS above, w.conv_id AS parent_conv_id
  FROM nodes v LEFT JOIN p q ON q.conv_id = v.conv_id AND q.depth = v.depth - 1
    LEFT JOIN nodes w ON w.depth = q.depth AND w.path = q.path),
children AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n FROM up WHERE depth > 0 GROUP BY depth, above),
leafy AS (SELECT u.*, coalesce(ch.n, 0) AS n_children FROM up u LEFT JOIN children ch ON ch.depth = u.depth AND ch.path = u.path),
sums AS (
  SELECT q.depth, q.path, sum(CASE WHEN l.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(l.saved) AS saved_tokens
  FROM leafy l JOIN p q ON q.conv_id = l.conv_id AND q.depth <= l.depth GROUP BY q.depth, q.path),
last AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
ends AS (
  SELECT p.depth, p.path, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
  FROM p JOIN last l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY p.depth, p.path)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, CAST(l.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM leafy l JOIN sums s ON s.depth = l.depth AND s.path = l.path LEFT JOIN ends e ON e.depth = l.depth AND e.path = l.path
"""


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("detections")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_jaccard, op2_fixity, op3_repeats, op4_exact, op5_quality, op6_toxicity, op7_packing, op8_chat, op9_mixing, op10_neighbours, op11_manifest, op12_trie, op13_licenses, pipeline)
}
ORACLES: dict[str, str] = {"op2_fixity": OP2_SQL, "op4_exact": OP4_SQL, "op11_manifest": OP11_SQL, "op12_trie": OP12_SQL}
