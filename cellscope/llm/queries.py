"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.llm import byte_bpe, conversation_repair, decontaminate, deleted_interpolation, embedding_forest, html_template, importance_resampling, line_minhash
from cellscope.llm import minhash_hamming, pack_ffd, secrets_scan, shard_bfd, toxicity_knn
from cellscope.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_hamming.near_duplicates(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interpolation.score_documents(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_knn.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_bfd.assign_shards(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_ffd.pack_documents(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_minhash.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_documents(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_secret_scan, op2_decontamination, op3_embedding_dedup, op4_minhash_dedup, op5_html_extraction,
                                     op6_lm_scoring, op7_toxicity, op8_sharding, op9_packing, op10_line_dedup, op11_conversation_repair, op12_byte_bpe,
                                     op13_importance_resampling)}
    return found


_COMPONENTS = """
, reach(id, other) AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), walk(id, seen) AS (
    SELECT DISTINCT id, id FROM reach UNION SELECT w.id, r.other FROM walk w JOIN reach r ON w.seen = r.id
), comps AS (SELECT id, min(seen) AS component FROM walk GROUP BY id)
"""

OP2_SQL = r"""
WITH words AS (
    SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), grams AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words CROSS JOIN sizes WHERE len(w) >= n)
), found AS (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.win = x.win AND g.n = x.n
), hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(m.list, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

OP3_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e, list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)) AS norm
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
), links AS (
    SELECT x.id AS a, y.id AS b FROM good x JOIN good y ON x.label = y.label AND x.id < y.id AND len(x.e) = len(y.e)
    WHERE x.norm > 0 AND y.norm > 0 AND list_inner_product(x.e, y.e) / sqrt(x.norm * y.norm) >= 0.98
)""" + _COMPONENTS + """, degree AS (SELECT id, count(*) AS n FROM reach GROUP BY id)
SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, coalesce(c.component, v.vec_id) AS component_id, coalesce(c.component, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN degree d ON v.vec_id = d.id LEFT JOIN comps c ON v.vec_id = c.id
"""

OP4_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id AS id, CASE WHEN text IS NULL THEN [] ELSE
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id
), meet AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL
), links AS (SELECT a, b FROM meet JOIN sizes p ON a = p.id JOIN sizes q ON b = q.id WHERE 100 * meet.n >= 75 * (p.n + q.n - meet.n))
""" + _COMPONENTS + """
SELECT w.id AS doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component, w.id) AS component_id, coalesce(c.component, w.id) = w.id AS kept
FROM words w LEFT JOIN sizes s USING (id) LEFT JOIN comps c USING (id)
"""

OP10_SQL = rf"""
WITH RECURSIVE cut AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL
), distinct_lines AS (
    SELECT row_number() OVER (ORDER BY line) AS id, line FROM (SELECT DISTINCT line FROM cut)
    WHERE length(line) >= {line_minhash.MIN_CHARS} OR regexp_matches(line, '([^ \t\x0B\f\r]+[ \t\x0B\f\r]+){{{line_minhash.SHORT_WORDS - 1}}}[^ \t\x0B\f\r]')
), shingles AS (
    SELECT DISTINCT id, hash(substr(line, i, {line_minhash.SHINGLE})) AS s
    FROM (SELECT id, line, unnest(range(1, length(line) - {line_minhash.SHINGLE} + 2)) AS i FROM distinct_lines WHERE length(line) >= {line_minhash.MIN_CHARS})
), sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id
), meet AS (SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL
), links AS (SELECT a, b FROM meet JOIN sizes p ON a = p.id JOIN sizes q ON b = q.id WHERE 100 * meet.n >= {line_minhash.SIMILARITY} * (p.n + q.n - meet.n))
""" + _COMPONENTS + """
, placed AS (SELECT cut.*, coalesce(c.component, d.id) AS component FROM cut LEFT JOIN distinct_lines d ON cut.line = d.line LEFT JOIN comps c ON d.id = c.id
), marked AS (SELECT *, component IS NULL OR row_number() OVER (PARTITION BY component ORDER BY doc_id, line_no) = 1 AS stays FROM placed
), kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE stays) AS n_kept, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE stays), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, k.text, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_kept, 0) AS BIGINT) AS n_kept FROM documents d LEFT JOIN kept k USING (doc_id)
"""

#: crc32 of the bytes of column ``{0}``, with the code's table as column ``crc_table``.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"""
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda v: list_reduce(list_prepend(v::BIGINT, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table)"""

#: What the repair costs from a row on, for each state of the roles kept so far: 0 nothing, 1 system, 2 user last, 3 assistant last.
_NEXT_ROLE = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def _repair_step() -> str:
    """Columns f0 to f3 after one more row (going left) from those of the recursion, then after insertions."""
    def edit(f, cost, letter, line):
        return f"{{'c': {f}.c + {cost}, 'a': '{letter}' || {f}.a, 'l': {f'list_prepend({line}, {f}.l)' if line else f'{f}.l'}}}"

    columns = []
    for state, (role, then) in _NEXT_ROLE.items():
        kept = " ".join(f"WHEN p.initial = '{i}' THEN {edit(f'w.f{to}', 'p.late', 'K', 'p.line')}" for i, to in ({"u": 2, "s": 1} if state == 0 else {role[0]: then}).items())
        columns.append(f"""CASE WHEN p.must_go THEN {edit(f'w.f{state}', 3, 'D', '')} ELSE list_min([{edit(f'w.f{state}', 3, 'D', '')},
            {edit(f'w.f{then}', '2 + p.late', 'R', f"'{role}:' || p.text")}, CASE {kept} END]) END AS f{state}""")
    return ", ".join(columns)


def _repair_insert(source: str) -> str:
    return ", ".join(f"list_min([{source}.f{state}, {{'c': {source}.f{then}.c + 2, 'a': 'I' || {source}.f{then}.a, 'l': list_prepend('{role}:', {source}.f{then}.l)}}]) AS f{state}"
                     for state, (role, then) in _NEXT_ROLE.items())


_NOTHING = "{'c': 0::BIGINT, 'a': '', 'l': CAST([] AS VARCHAR[])}"
_NEVER = "{'c': 1000000::BIGINT, 'a': '', 'l': CAST([] AS VARCHAR[])}"

OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE}, coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format("k")} % 20 AS code
    FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations) CROSS JOIN crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded WHERE code <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
), faults AS (
    SELECT conv_id, turn, i, role, text, substr(role, 1, 1) AS initial, role || ':' || text AS line, seen = '' AS blank, seen <> '' AND again AS twice,
        seen <> '' AND NOT again AND right(seen, 1) NOT IN ('.', '!', '?') AS truncated FROM numbered
), pairs AS (SELECT conv_id, initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM faults
), prepared AS (SELECT *, blank OR twice AS must_go, CAST(truncated AS BIGINT) AS late FROM faults
), walk AS (
    SELECT conv_id, i, {_repair_insert("t")} FROM (SELECT conv_id, i, {_repair_insert("s")} FROM (
        SELECT conv_id, max(i) + 1 AS i, {_NOTHING} AS f0, {_NEVER} AS f1, {_NEVER} AS f2, {_NOTHING} AS f3 FROM prepared GROUP BY conv_id) s) t
    UNION ALL
    SELECT conv_id, i, {_repair_insert("t")} FROM (SELECT conv_id, i, {_repair_insert("s")} FROM (
        SELECT p.conv_id, p.i, {_repair_step()} FROM walk w JOIN prepared p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i - 1) s) t
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE twice) AS duplicate,
        count(*) FILTER (WHERE truncated) AS truncated FROM faults GROUP BY conv_id
), wrong AS (SELECT conv_id, count(*) AS illegal FROM pairs WHERE pair NOT IN ('su', 'ua', 'au') GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank, CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(x.illegal, 0) AS BIGINT) AS illegal, coalesce(w.f0.c, 0) AS cost, coalesce(w.f0.a, '') AS audit,
    sha256(coalesce(array_to_string(w.f0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN wrong x ON o.conv_id IS NOT DISTINCT FROM x.conv_id
LEFT JOIN walk w ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = 1
"""

OP13_SQL = rf"""
WITH {_CRC_TABLE}, texts AS (
    SELECT rowid AS r, doc_id, 's' AS side, text FROM (SELECT *, row_number() OVER () AS rowid FROM documents) UNION ALL SELECT -1, NULL, 't', text FROM benchmark
), words AS (
    SELECT r, doc_id, side, CASE WHEN text IS NULL THEN [] ELSE
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w FROM texts
), features AS (
    SELECT r, side, unnest(w) AS f FROM words UNION ALL
    SELECT r, side, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words WHERE len(w) > 1
), counted AS (SELECT r, side, f, count(*) AS n FROM features GROUP BY ALL
), dealt AS (SELECT f, {_CRC.format("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM counted) CROSS JOIN crc
), found AS (SELECT r, side, bucket, CAST(sum(n) AS BIGINT) AS n FROM counted JOIN dealt USING (f) GROUP BY ALL
), buckets AS (SELECT bucket, CAST(coalesce(sum(n) FILTER (WHERE side = 's'), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (WHERE side = 't'), 0) AS DOUBLE) AS t FROM found GROUP BY bucket
), whole AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t_all FROM buckets
), gains AS (SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM buckets CROSS JOIN whole
), weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight FROM found JOIN gains USING (bucket) WHERE side = 's' GROUP BY r
), scored AS (
    SELECT w.r, w.doc_id, coalesce(x.n_features, 0) AS n_features, coalesce(x.weight, 0) AS weight, len(w.w) >= 20 AS eligible,
        coalesce(x.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM words w LEFT JOIN weights x ON w.r = x.r WHERE w.side = 's'
), placed AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER (PARTITION BY eligible) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= n * 25 // 100 THEN place END AS rank FROM placed
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op3_embedding_dedup": OP3_SQL, "op4_minhash_dedup": OP4_SQL, "op10_line_dedup": OP10_SQL,
            "op11_conversation_repair": OP11_SQL, "op13_importance_resampling": OP13_SQL}
