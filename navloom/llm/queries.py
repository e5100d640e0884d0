"""Registered queries of the operators, and their oracles in DuckDB where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm import conversations, pii, secret_scan, spelling, warc
from navloom.llm.common import table
from navloom.llm.exact_dedup import exact_dedup
from navloom.llm.html_extract import extract_text
from navloom.llm.jaccard import jaccard_components
from navloom.llm.maxent import maxent_scores
from navloom.llm.mixing import mix_sources
from navloom.llm.neighbours import nearest
from navloom.llm.packing import pack
from navloom.llm.toxicity import learn, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", *secret_scan.summary())


def _spans_sql(place: int, rule: secret_scan.Rule) -> str:
    """Spans of one rule: the lengths of the pieces between the matches, and of the matches, add up to positions."""
    pattern = rule.pattern.replace("}+", "}").replace("'", "''")  # no possessive repeats in this dialect
    part = f"length(parts[i + 1]) >= {rule.least}" if rule.least else "true"
    return f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, first, first + length(hits[i + 1]) AS last FROM (
    SELECT *, coalesce(list_sum(list_transform(gaps[1:i + 1], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(hits[1:i], lambda h: length(h))), 0) AS first FROM (
        SELECT *, unnest(range(len(hits))) AS i FROM (
            SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {rule.group}) AS parts FROM texts
        ))) WHERE {part}"""


_RULES = secret_scan.BASE + secret_scan.MORE
_LINE = "string_agg(concat_ws(':', kind, first::BIGINT, last::BIGINT), ',' ORDER BY first, place)"
OP1_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_spans_sql(k, r) for k, r in enumerate(_RULES))}),
lines AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)},
        {_LINE} FILTER (place < {len(secret_scan.BASE)}) AS base, {_LINE} AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lines USING (doc_id)
"""


def op2_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", *pii.summary())


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group."""
    found = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = """
WITH bare AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare, length(coalesce(text, '')) AS size
    FROM documents
), groups AS (
    SELECT bare, count(*) AS group_size, first(doc_id ORDER BY size DESC, doc_id) AS keep_id FROM bare GROUP BY bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM bare JOIN groups USING (bare)
"""


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its bucket, batch and place."""
    found = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_tokens", "bucket", "bucket_length", "batch", "place", "padding")


def op6_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its add-one unigram score and its score by the model, learnt outside fold 2 of 7."""
    found = maxent_scores(table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2)).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def in_fold(name: str, folds: int, fold: int):
    """Whether the CRC of an id's digits falls into the fold; no id: the CRC of no text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the calibrated score of its toxic passages, learnt from the labels outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").where(~in_fold("doc_id", 5, 0)))
    found = score_toxicity(docs, model).select("row.doc_id", "score", "predicted", F.size("passages").alias("n_passages"))
    return found.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", "predicted", "n_passages")


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of all documents, shares by the square root of a source's size, in shuffled order."""
    return mix_sources(table(spark, sf_dir, "documents")).select("row.*", "copy_no", "shuffle_key")


OP9_SQL = """
WITH sizes AS (
    SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source
), shares AS (
    SELECT source, size, CASE WHEN size > 0 THEN sqrt(size) ELSE 0 END AS share FROM sizes
), rates AS (
    SELECT source, CASE WHEN size > 0 THEN share / (SELECT sum(share) FROM shares) * (SELECT sum(size) FROM shares) / size ELSE 0 END AS rate
    FROM shares
), draws AS (
    SELECT source, greatest(ceil(rate / 8), 1)::INT AS draws, rate / greatest(ceil(rate / 8), 1) AS mean FROM rates
), terms AS (
    SELECT source, sum(exp(-mean) * pow(mean, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k) AS below
    FROM draws, range(0, 65) AS ks(k)
), tries AS (
    SELECT doc_id, source, ('0x' || substr(md5(concat_ws(':', '17', coalesce(doc_id::VARCHAR, 'null'), draw)), 1, 13))::UBIGINT / pow(2, 52) AS u
    FROM documents JOIN draws USING (source), unnest(range(1, draws + 1)) AS t(draw)
), counts AS (
    SELECT doc_id, count(*) AS n FROM tries JOIN terms ON terms.source = tries.source AND below <= u GROUP BY doc_id
)
SELECT documents.*, copy_no::INT AS copy_no, md5(concat_ws(':', 'shuffle 17', coalesce(doc_id::VARCHAR, 'null'), copy_no)) AS shuffle_key
FROM documents JOIN counts USING (doc_id), unnest(range(1, n + 1)) AS c(copy_no)
"""

def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component under links of 3-word shingle sets at 90 percent."""
    found = jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


OP10_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
    END AS grams FROM words
), posts AS (
    SELECT doc_id, len(grams) AS size, unnest(grams) AS gram FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM posts a JOIN posts b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT sets.doc_id, len(grams) AS n_shingles, min(other) AS component_id FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id, grams
"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults: by the CRC of ``conv_id:turn`` modulo 20 a row goes, loses its text or its sentence ends,
    stands twice, or gets the role user.  Nulls are one space; a null id or turn stays null."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat_ws(":", told("conv_id"), told("turn")).cast("binary")), F.lit(20))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    role = F.when(fate == 4, "user").otherwise(told("role"))
    rows = rows.where(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return rows.drop("col")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with its faults after damage, the cheapest edits that repair it and a hash of what they leave."""
    rows = table(spark, sf_dir, "conversations")
    found = conversations.reports(conversations.repair_conversations(damaged(rows)))
    ids = rows.select("conv_id").distinct().withColumn("key", conversations.key_of(F.col("conv_id")))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")]
    return ids.join(found, "key", "left").select("conv_id", *counts, *texts)


#: CRC-32 of a text's UTF-8: bit by bit for a table of 256 numbers (``crc``, whose column ``t`` has to be in scope), then byte by byte.
CRC_TABLE = """bits AS (
    SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(b)
), crc AS (SELECT list(c ORDER BY b) AS t FROM bits)"""


def _crc(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda k: ('0x' || substr(hex(encode({text})), 2 * k::INT + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, o: xor(c >> 8, t[(xor(c, o) & 255)::INT + 1])), 4294967295)"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _to(state: int, cost: str, edit: str, line: str | None = None, when: str = "true") -> str:
    """What one edit makes of the best (cost, audit, text) of a state; null where there is none."""
    text = f"s{state}.t || {line} || chr(10)" if line else f"s{state}.t"
    return f"CASE WHEN {when} AND s{state} IS NOT NULL THEN {{'c': s{state}.c + {cost}, 'a': s{state}.a || '{edit}', 't': {text}}} END"


def _inserted(rows: str) -> str:
    user = _least("s2", *[_to(k, "2", "I", "'user:'") for k in (0, 1, 3)])
    return f"SELECT conv_id, k, s0, s1, {user} AS s2, {_least('s3', _to(2, '2', 'I', repr('assistant:')))} AS s3 FROM ({rows})"


_KEPT = "role || ':' || text"
_USER = [_to(k, "cut", "K", _KEPT, "code = 'u'") for k in (0, 1, 3)] + [_to(k, "2 + cut", "R", "'user:' || text", "code <> 'x'") for k in (0, 1, 3)]
_ASSISTANT = [_to(2, "cut", "K", _KEPT, "code = 'a'"), _to(2, "2 + cut", "R", "'assistant:' || text", "code <> 'x'")]
_STEP = f"""SELECT best.conv_id, best.k + 1 AS k, {_to(0, '3', 'D')} AS s0, {_least(_to(1, '3', 'D'), _to(0, 'cut', 'K', _KEPT, "code = 's'"))} AS s1,
        {_least(_to(2, '3', 'D'), *_USER)} AS s2, {_least(_to(3, '3', 'D'), *_ASSISTANT)} AS s3
    FROM best JOIN coded ON coded.conv_id IS NOT DISTINCT FROM best.conv_id AND coded.k = best.k + 1"""
_START = "SELECT conv_id, 0::BIGINT AS k, {'c': 0::BIGINT, 'a': '', 't': ''} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s3 FROM ids"

#: A dynamic program over the rows with the best (cost, audit, repaired text) of each place a repaired conversation can stand at.
OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
fates AS (SELECT * EXCLUDE (t), {_crc("name")} % 20 AS fate FROM named, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM fates, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS u(copy) WHERE fate <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM damaged
), faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
        WHEN regexp_matches(text, '[^.!?\\x20\\x09-\\x0D][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1] AS two
    FROM placed
), coded AS (
    SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS code, (coalesce(fault, '') = 'truncated')::BIGINT AS cut FROM faulty
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS k
    FROM coded GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations),
best AS (
    {_inserted(_inserted(_START))}
    UNION ALL
    {_inserted(_inserted(_STEP))}
), ends AS (SELECT conv_id, k, {_least("s0", "s3")} AS s FROM best)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(s.c, 0) AS cost, coalesce(s.a, '') AS audit, sha256(coalesce(substr(s.t, 1, length(s.t) - 1), '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM ids.conv_id AND ends.k = counts.k
""".replace("SELECT conv_id, coalesce(gaps", "SELECT ids.conv_id, coalesce(gaps")


def op12_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the deduplicated archives hold it."""
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("original_page").alias("refers_to"))


OP12_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (SELECT *, octet_length(encode(payload)) AS size, max(page_id) OVER (PARTITION BY payload) AS original FROM payloads)
SELECT page_id, size AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN size >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN size >= 1000 AND page_id <> original THEN original END AS refers_to
FROM sized
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, with misspellings planted by a CRC, and the form that it varies."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), slip=199)
    return spelling.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


#: Near words share what is left of them without one letter, at the same place, or one of them is what is left of the other.
OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), distinct_runs AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT id, run, n, {_crc("(id || ':' || run)")} AS h FROM distinct_runs, crc),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
rests AS (SELECT word, n, k, substr(word, 1, k::INT) || substr(word, k::INT + 2) AS rest FROM words, unnest(range(length(word))) AS u(k)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM rests a JOIN rests b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word
), best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * words.n THEN other END AS form, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), paths(word, root, onward) AS (
    SELECT word, word, form FROM forms UNION ALL SELECT paths.word, forms.word, forms.form FROM paths JOIN forms ON forms.word = paths.onward
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN paths USING (word) WHERE onward IS NULL
"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_secret_scan, op2_graph_neighbours, op3_personal_data, op4_exact_dedup, op5_length_buckets, op6_maxent_scores, op7_main_text, op8_toxicity, op9_poisson_mixing, op10_jaccard_join, op11_conversation_repair, op12_warc_revisits, op13_spelling_variants)}
ORACLES: dict[str, str] = {"op1_secret_scan": OP1_SQL, "op4_exact_dedup": OP4_SQL, "op9_poisson_mixing": OP9_SQL, "op10_jaccard_join": OP10_SQL, "op11_conversation_repair": OP11_SQL, "op12_warc_revisits": OP12_SQL, "op13_spelling_variants": OP13_SQL}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
