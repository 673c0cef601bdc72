"""The registered queries of this subpackage, and SQL for those that SQL can
express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (alignment, bpe, chat, decontam, jaccard, langid, licences, lines, packing,
                         periods, repeats, token_files, topk)
from marquee.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without later copies of repeated runs of two lines or
    more."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("line_count").alias("n_lines"), F.col("removed_lines").alias("n_removed"),
                      F.col("removed_runs").alias("n_runs"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = """
WITH cut AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents WHERE text IS NOT NULL
), two AS (
    SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY place) AS next FROM cut
), later AS (
    SELECT doc_id, place, next IS NOT NULL
        AND row_number() OVER (PARTITION BY line, next ORDER BY doc_id, place) > 1 AS goes
    FROM two
), marked AS (
    SELECT cut.doc_id, cut.place, cut.line,
           later.goes OR coalesce(lag(later.goes) OVER (PARTITION BY cut.doc_id ORDER BY cut.place), false) AS gone
    FROM cut JOIN later USING (doc_id, place)
), runs AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS begins FROM marked
)
SELECT doc_id, count(place) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM runs GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, formatted and read back."""
    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(hard).alias("text"))
        for i, role in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_turns(turns.unionByName(extra)))


OP2_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
    SELECT *,
        contains(role, '###') OR contains(text, '###') OR contains(role, '</turn>') OR contains(text, '</turn>')
            OR contains(role, ': ') AS has_control,
        regexp_matches(role, '\\[\\hcs]') OR regexp_matches(text, '\\[\\hcs]') AS has_escape,
        replace(replace(replace(role, '###', '\h'), '</turn>', '\c'), ': ', '\s') AS role_1,
        replace(replace(text, '###', '\h'), '</turn>', '\c') AS text_1,
        (length(role) - length(replace(role, '\', ''))) + (length(text) - length(replace(text, '\', ''))) AS slashes
    FROM turns
), sized AS (
    SELECT *,
        -- escaping only control strings comes back unless a backslash of the source
        -- begins an escape, of its own or with the escape that follows it
        CASE WHEN NOT has_control AND NOT has_escape THEN length(role) + length(text)
             WHEN NOT has_escape AND NOT regexp_matches(role, '\\(###|</turn>|: )')
                  AND NOT regexp_matches(text, '\\(###|</turn>)') THEN length(role_1) + length(text_1)
             ELSE length(role_1) + length(text_1) + slashes END + 14 AS shown_chars
    FROM marked
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                    FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(shown_chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from the labels of those
    that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()).select("text", "lang"))
    rows = docs.select("doc_id", langid.held_out().alias("held_out"), "text")
    return langid.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded by the rank file and decoded again."""
    out = bpe.encode_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of whole documents whose 5-word shingle sets have a Jaccard
    similarity of 0.75 or more."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without the bytes of 200-byte strings that also start
    elsewhere."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of whole documents by known sentences and ordered rules."""
    return licences.find_licences(table(spark, sf_dir, "documents"))


def _op7_sql() -> str:
    steps = ", ".join(f"replace(s{i}, '{rule}', '-') AS s{i + 1}" for i, (_, rule) in enumerate(licences.RULES))

    def count(i: int, rule: str) -> str:
        if len(rule) == 1:
            return f"length(s{i}) - length(replace(s{i}, '{rule}', ''))"
        return f"(length(s{i}) - length(s{i + 1})) // {len(rule) - 1}"
    names = dict.fromkeys(name for name, _ in licences.RULES)
    found = " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS licence, "
        + " + ".join(count(i, rule) for i, (own, rule) in enumerate(licences.RULES) if own == name)
        + " AS n_matches FROM steps" for name in names)
    known = ", ".join(f"('{letter}', '{text}')" for letter, text in licences.SENTENCES)
    return rf"""
WITH known(sentence, normal) AS (VALUES {known}),
cut AS (
    SELECT doc_id, string_split(regexp_replace(text, '{licences.SPLIT}', '\1' || chr(10), 'g'), chr(10)) AS parts
    FROM documents
), parts AS (
    SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut
), found AS (
    SELECT doc_id, place, sentence FROM parts
    JOIN known ON trim(regexp_replace(lower(part), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) = normal
), ids AS (
    SELECT doc_id, string_agg(sentence, '' ORDER BY place) AS s0 FROM found GROUP BY doc_id
), steps AS (SELECT doc_id, s0, {steps} FROM ids)
SELECT * FROM ({found}) WHERE n_matches > 0
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of benchmark items, and the items."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document written to token files and read back."""
    return token_files.token_files(spark, table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other rows of every hundredth vector."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.filter(F.col("vec_id") % 100 == 0), vectors, k=10)


OP10_SQL = """
WITH own AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM own
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document's tokens of two tokenizers, aligned by bytes."""
    groups = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = alignment.align_texts(table(spark, sf_dir, "documents")).withColumn("groups_sha256", groups).drop("groups")
    return alignment.score_links(materialize(aligned, "alignment")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def repetitive_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``: every document, the words of a tenth of them (by
    crc32 of the id) repeated with some period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("words")
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    cut = docs.select("doc_id", "text", words.alias("words"), g.alias("g")) \
        .withColumn("a", F.when(n > 0, F.col("g") % n)) \
        .withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    head, rest = F.slice("words", 1, F.col("a").cast("int")), n - F.col("a")
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    again = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest.cast("int"))
    return cut.select("doc_id", F.when(n > 0, F.array_join(F.concat(head, again), " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in whole documents, a tenth of which were made
    repetitive."""
    found = periods.periodic_runs(repetitive_documents(table(spark, sf_dir, "documents")))
    shown = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", periods.greatest_run()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(shown, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP12_SQL = r"""
WITH RECURSIVE bits(byte, step, c) AS (
    SELECT byte, 0, byte FROM range(256) AS t(byte)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE step < 8
), bytes AS (
    SELECT list(c ORDER BY byte) AS crc FROM bits WHERE step = 8
), hashed AS (
    SELECT doc_id, list_filter(regexp_split_to_array(text, '[ 	-]+'), lambda w: w <> '') AS w,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                        lambda x, y: xor(x >> 8, crc[1 + (xor(x, y) & 255)])), 4294967295) AS h
    FROM documents, bytes
), placed AS (
    SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a
    FROM hashed
), shaped AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed
), texts AS (
    SELECT doc_id, n, CASE WHEN made THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                           ELSE w END AS w
    FROM shaped
), words AS (
    SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts WHERE n > 0
), steps AS (
    -- a run of period q and at least 4 q words has equal words q apart at two multiples of q
    SELECT doc_id, w, n, q, unnest(range(0, n - 2 * q, q)) AS i
    FROM (SELECT doc_id, w, n, unnest(range(1, n // 4 + 1)) AS q FROM texts WHERE n >= 6)
), periods AS (
    SELECT DISTINCT doc_id, n, q FROM steps WHERE w[1 + i] = w[1 + i + q] AND w[1 + i + q] = w[1 + i + 2 * q]
), equal AS (
    SELECT periods.doc_id, q, x.i, x.i - row_number() OVER (PARTITION BY periods.doc_id, q ORDER BY x.i) AS island
    FROM periods JOIN words AS x ON x.doc_id = periods.doc_id JOIN words AS y ON y.doc_id = x.doc_id AND y.i = x.i + q AND y.word = x.word
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY doc_id, q, island
    HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), best AS (
    SELECT doc_id, arg_min(struct_pack(start, length, period), struct_pack(k, start, period)) AS r, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS shown
    FROM (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC) AS k FROM runs) GROUP BY doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(n_runs, 0) AS n_runs, r.start, r.length, r.period,
    (1000 * r.length) // r.period AS exponent_milli,
    sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""


def op13_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document's pieces in sequences of 4096 ids, packed along a
    Hilbert curve."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_chat_format, op3_language_id, op4_byte_bpe, op5_ngram_jaccard, op6_suffix_repeats,
        op7_licence_scan, op8_decontamination, op9_token_files, op10_exact_top_k, op11_token_alignment,
        op12_periodic_runs, op13_curve_packing)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op2_chat_format": OP2_SQL, "op7_licence_scan": _op7_sql(),
            "op10_exact_top_k": OP10_SQL, "op12_periodic_runs": OP12_SQL}
