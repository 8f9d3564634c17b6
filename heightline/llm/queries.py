"""The registered queries of the package, each over whole tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, crf, exact, language, lines, merkle, mixing, packing, passages, quality, repair, simhash, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def _remainder(id: str, parts: int):
    return F.coalesce(F.crc32(F.col(id).cast("string")) % parts, F.lit(-1))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.fingerprint_hex(F.col("mark")).alias("fingerprint"), "component_id"
    )


@query(
    "op2_exact",
    r"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           row_number() OVER w = 1 AS kept,
           sha256(body) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)
    """,
)
def op2_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    digested = docs.withColumn("text_sha256", F.sha2(exact.normalised(F.col("text")), 256))
    return exact.exact_duplicates(digested).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op3_mixing",
    """
    WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    r AS (SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM s) * (SELECT sum(n) FROM s) / n AS rate FROM s),
    k AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 24) AS BIGINT) + 1)) AS k FROM r),
    l AS (SELECT source, k,
                 sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate / k) END) OVER (PARTITION BY source ORDER BY k) AS log_p FROM k),
    c AS (SELECT source, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY k) AS below FROM l),
    u AS (SELECT *, CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS at FROM documents),
    d AS (SELECT u.doc_id, count(*) AS times FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.below <= u.at
          GROUP BY u.doc_id),
    e AS (SELECT doc_id, unnest(range(1, times + 1)) AS copy FROM d)
    SELECT doc_id, text, lang, source, n_chars, copy,
           CAST('0x' || substr(md5('mix-order:' || doc_id || ':' || copy), 1, 13) AS BIGINT) AS mix_key
    FROM e JOIN documents USING (doc_id)
    """,
)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder("doc_id", 3) == 1
    lexicon = toxicity.learn(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def _js(p: str, q: str) -> str:
    part = "CASE WHEN {0} > 0 THEN {0} * ln({0} / (({1} + {2}) / 2)) ELSE 0 END"
    return f"{part.format(p, p, q)} + {part.format(q, p, q)}"


_BINS = [(f"s[{i}]", f"cls[{i}]") for i in range(1, 7)]


@query(
    "op6_quality",
    rf"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text,
                      list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    c AS (SELECT doc_id, lang, w, len(w) AS n, length(text) AS chars, length(list_aggregate(w, 'string_agg', '')) AS word_chars,
                 [length(regexp_replace(text, '[^A-ZÀ-ÖØ-ÞΑ-ΩА-Я]', '', 'g')), length(regexp_replace(text, '[^0-9]', '', 'g')),
                  length(regexp_replace(text, '[^.,;:!?''\"()-]', '', 'g')), length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')),
                  length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g'))] AS k,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    win AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS win FROM (SELECT doc_id, w, unnest(range(1, n - 1)) AS i FROM c)),
    rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS times FROM win),
    cov AS (SELECT doc_id, count(DISTINCT p) AS covered
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE times > 1) GROUP BY doc_id),
    base AS (SELECT c.*, coalesce(covered, 0) AS covered, n < 50 OR 100 * coalesce(covered, 0) > 50 * n AS failed
             FROM c LEFT JOIN cov USING (doc_id)),
    ref AS (SELECT lang, sum(n) AS words, sum(chars) AS chars,
                   [sum(k[1]) / sum(chars), sum(k[2]) / sum(chars), sum(k[3]) / sum(chars), sum(k[4]) / sum(chars),
                    sum(k[5]) / sum(chars)] AS five
            FROM c WHERE lang IS NOT NULL GROUP BY lang
            HAVING sum(n) >= 2000 OR (count(*) >= 0.01 * (SELECT count(*) FROM c) AND sum(n) > 0)),
    refs AS (SELECT lang, words, list_append(five, greatest(0, 1 - list_sum(five))) AS cls FROM ref),
    top AS (SELECT lang, word, count(*) / any_value(words) AS q
            FROM (SELECT lang, unnest(w) AS word FROM c) JOIN refs USING (lang) WHERE length(word) <= 4 GROUP BY lang, word
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) <= 24),
    alls AS (SELECT lang, sum(q) AS q_all FROM top GROUP BY lang),
    wc AS (SELECT doc_id, word, count(*) AS times FROM (SELECT doc_id, unnest(w) AS word FROM c) GROUP BY ALL),
    hit AS (SELECT base.doc_id, top.lang, times / n AS p, q FROM wc JOIN top USING (word) JOIN base ON base.doc_id = wc.doc_id),
    sums AS (SELECT doc_id, lang, sum({_js('p', 'q')}) AS twice, sum(p) AS p_in, sum(q) AS q_in FROM hit GROUP BY ALL),
    pairs AS (SELECT b.doc_id, b.n, b.chars, r.lang, r.cls, a.q_all,
                     list_transform(b.k, lambda x: x / b.chars) AS five,
                     coalesce(twice, 0) AS twice, greatest(0, 1 - coalesce(p_in, 0)) AS p_out, coalesce(q_in, 0) AS q_in
              FROM base b CROSS JOIN refs r LEFT JOIN alls a ON a.lang = r.lang
              LEFT JOIN sums s ON s.doc_id = b.doc_id AND s.lang = r.lang
              WHERE b.lang IS NULL OR b.lang IN (SELECT lang FROM refs)),
    bins AS (SELECT *, list_append(five, greatest(0, 1 - list_sum(five))) AS s, greatest(0, 1 - q_all) AS q_out FROM pairs),
    far AS (SELECT doc_id,
                   min(CASE WHEN chars >= 100 THEN sqrt(greatest(0, {' + '.join(_js(p, q) for p, q in _BINS)}) / (2 * ln(2))) END) AS characters,
                   min(CASE WHEN n >= 50 THEN
                       sqrt(greatest(0, twice + {_js('p_out', 'q_out')} + (q_all - q_in) * ln(2)) / (2 * ln(2))) END) AS words
            FROM bins GROUP BY doc_id)
    SELECT doc_id, n AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, k[4] AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, covered AS n_repeat_words, failed AS base_failed,
           NOT failed AND coalesce(characters, 0) <= 0.28 AND coalesce(words, 0) <= 0.37 AS kept
    FROM base LEFT JOIN far USING (doc_id)
    """,
)
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.assess(docs.select("doc_id", "text", "lang"), quality.references(docs), lang="lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op7_passages")
def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder("doc_id", 4) == 2
    profiles = language.learn(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language.identify(F.col("text"), profiles).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query(
    "op9_lines",
    r"""
    WITH o AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
               FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
    f AS (SELECT line, min(struct_pack(d := doc_id, a := pos)) AS first, length(line) AS size FROM o
          WHERE length(line) >= 20 AND regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line),
    s AS (SELECT *, unnest(range(size - 2, size + 3)) AS near_size FROM f),
    n AS (SELECT DISTINCT a.line FROM s a JOIN f b ON a.near_size = b.size AND b.first < a.first AND a.line <> b.line
          WHERE levenshtein(a.line, b.line) <= 2),
    j AS (SELECT o.*, f.line IS NOT NULL AND (n.line IS NOT NULL OR f.first <> struct_pack(d := o.doc_id, a := o.pos)) AS gone
          FROM o LEFT JOIN f USING (line) LEFT JOIN n USING (line))
    SELECT d.doc_id, coalesce(count_if(gone), 0)::INT AS lines_removed,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), CASE WHEN d.text IS NOT NULL THEN '' END) AS text
    FROM documents d LEFT JOIN j USING (doc_id) GROUP BY d.doc_id, d.text
    """,
)
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs)


_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"


@query(
    "op10_chat",
    rf"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
               UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(4 + 2 + 8 + length(replace({_ESCAPED.format('role')}, ':', '\:')) + length({_ESCAPED.format('text')}))::BIGINT
               AS formatted_chars
    FROM t GROUP BY conv_id
    """,
)
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digest(chat.format_turns(rows)).withColumnRenamed("id", "conv_id")


@query("op11_line_crf")
def op11_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder("doc_id", 5) == 0
    model = crf.learn(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), crf.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def _crc32(ascii: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of an ASCII text; the polynomial is fixed."""
    codes = f"list_transform(range(1, length({ascii}) + 1), lambda i: ascii(({ascii})[i])::BIGINT)"
    turned = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {turned}), 4294967295)"


def _sql_field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _sql_tree(name: str, leaves: str, levels: int) -> str:
    """CTEs of a forest: ``name_k`` has (tree, pos, node) of level k, ``name_sib`` the siblings of each node."""
    parts = [f"{name}_0 AS (SELECT tree, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(levels):
        parts.append(
            f"{name}_{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (SELECT tree, pos // 3 AS pos, "
            f"CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node "
            f"FROM {name}_{k} GROUP BY tree, pos // 3))"
        )
    sides = " UNION ALL ".join(
        f"SELECT {k} AS level, a.tree, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before, "
        f"coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after "
        f"FROM {name}_{k} a JOIN {name}_{k} b ON a.tree IS NOT DISTINCT FROM b.tree AND a.pos // 3 = b.pos // 3 "
        f"WHERE a.n > 1 GROUP BY a.tree, a.pos"
        for k in range(levels)
    )
    parts.append(f"{name}_sib AS ({sides})")
    return ",\n    ".join(parts)


_DEEP, _HIGH = 13, 6
_TAMPERED = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


@query(
    "op12_merkle",
    rf"""
    WITH RECURSIVE docs AS (SELECT doc_id, source, {_sql_leaf('text')} AS leaf, {_sql_leaf('tampered')} AS altered
                            FROM (SELECT *, {_TAMPERED} AS tampered FROM documents)),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
    low AS (SELECT source AS tree, pos, leaf AS node FROM leaves),
    {_sql_tree('t', 'low', _DEEP)},
    subs AS (SELECT tree AS source, node AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos FROM t_{_DEEP}),
    up AS (SELECT 0 AS tree, pos, subroot AS node FROM subs),
    {_sql_tree('u', 'up', _HIGH)},
    sib AS (SELECT level, tree AS source, pos, before, after FROM t_sib
            UNION ALL SELECT {_DEEP} + level, subs.source, u_sib.pos, before, after
            FROM u_sib JOIN subs ON subs.pos // (3 ** level)::BIGINT = u_sib.pos),
    walk AS (SELECT doc_id, source, pos, leaf, leaf AS node, altered AS other, '' AS siblings, 0 AS level FROM leaves
             UNION ALL
             SELECT w.doc_id, w.source, w.pos, w.leaf,
                    CASE WHEN s.level IS NULL THEN w.node ELSE sha256(s.before || w.node || s.after) END,
                    CASE WHEN s.level IS NULL THEN w.other ELSE sha256(s.before || w.other || s.after) END,
                    w.siblings || coalesce(s.before || s.after, ''), w.level + 1
             FROM walk w LEFT JOIN sib s ON s.level = w.level AND s.source IS NOT DISTINCT FROM w.source
                  AND s.pos = CASE WHEN w.level < {_DEEP} THEN w.pos // (3 ** w.level)::BIGINT
                                  ELSE (SELECT any_value(subs.pos) FROM subs WHERE subs.source IS NOT DISTINCT FROM w.source)
                                       // (3 ** (w.level - {_DEEP}))::BIGINT END
             WHERE w.level < {_DEEP + _HIGH})
    SELECT w.doc_id, w.leaf, subs.subroot, u_{_HIGH}.node AS root, sha256(w.siblings) AS proof_sha256,
           w.other AS folded_root, w.other = u_{_HIGH}.node AS verified
    FROM walk w JOIN subs ON subs.source IS NOT DISTINCT FROM w.source, u_{_HIGH} WHERE w.level = {_DEEP + _HIGH}
    """,
)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    spoiled = F.when(
        F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))
    ).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.leaf_digest(*(spoiled if c == "text" else F.col(c) for c in columns))
    rows = merkle.manifest(docs.withColumn("tampered", tampered), columns, carry=["tampered"])
    folded = rows.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("proof")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn; dropped rows are marked ``gone``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    harmed = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return harmed.drop("copy")


_KEY = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
_NEXT = ("s2", "s2", "s3", "s2")
_MARK = {"s2": "user:", "s3": "assistant:"}


def _sql_state(i: int) -> str:
    """Least (cost, audit, repaired text with a line end each) from state ``i`` on, over the edits of the row itself."""

    def then(cost: str, mark: str, state: str, line: str) -> str:
        return f"struct_pack(c := {cost} + w.{state}.c, a := '{mark}' || w.{state}.a, t := {line} || w.{state}.t)"

    rerole = _NEXT[i]
    options = [then("3", "D", f"s{i}", "''")]
    keeps = {0: {"s": "s1", "u": "s2"}, 1: {"u": "s2"}, 2: {"a": "s3"}, 3: {"u": "s2"}}[i]
    for initial, state in keeps.items():
        kept = then("r.late", "K", state, "r.role || ':' || r.text || chr(10)")
        options.append(f"CASE WHEN NOT r.doomed AND r.role[1] = '{initial}' THEN {kept} END")
    moved = then("2 + r.late", "R", rerole, f"'{_MARK[rerole]}' || r.text || chr(10)")
    options.append(f"CASE WHEN NOT r.doomed THEN {moved} END")
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


def _sql_inserted(own: str, i: int, after: str) -> str:
    """The better of a state's own edits and a turn put in first."""
    return f"list_min([{own}, struct_pack(c := 2 + {after}.c, a := 'I' || {after}.a, t := '{_MARK[_NEXT[i]]}' || chr(10) || {after}.t)])"


@query(
    "op13_repair",
    rf"""
    WITH RECURSIVE harm AS (
      SELECT conv_id, turn, {_crc32(_KEY)} % 20 AS k, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
    rows AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
             FROM (SELECT *, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) FROM harm WHERE k <> 0)),
    marked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen,
                      NOT regexp_matches(text, '[^ 	-
]') AS blank,
                      NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS open FROM rows),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC, seen DESC) AS i,
                 lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS before,
                 blank OR seen > 1 AS doomed, CASE WHEN NOT blank AND seen = 1 AND open THEN 1 ELSE 0 END AS late FROM marked),
    w AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, struct_pack(c := 0::BIGINT, a := '', t := '') AS s0,
                 struct_pack(c := 4::BIGINT, a := 'II', t := 'user:' || chr(10) || 'assistant:' || chr(10)) AS s1,
                 struct_pack(c := 2::BIGINT, a := 'I', t := 'assistant:' || chr(10)) AS s2,
                 struct_pack(c := 0::BIGINT, a := '', t := '') AS s3 FROM conversations
          UNION ALL
          SELECT conv_id, i, {_sql_inserted('o0', 0, 'n2')}, {_sql_inserted('o1', 1, 'n2')}, n2, n3
          FROM (SELECT *, {_sql_inserted('o2', 2, 'o3')} AS n2, {_sql_inserted('o3', 3, 'o2')} AS n3
                FROM (SELECT w.conv_id, w.i + 1 AS i, {', '.join(f'{_sql_state(i)} AS o{i}' for i in range(4))}
                      FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))),
    f AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
                 count_if(NOT blank AND seen > 1) AS duplicate, sum(late)::BIGINT AS truncated,
                 count_if(before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
          FROM r GROUP BY conv_id)
    SELECT w.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, s0.c AS cost, s0.a AS audit,
           sha256(CASE WHEN s0.t = '' THEN '' ELSE left(s0.t, length(s0.t) - 1) END) AS repaired_sha256
    FROM w LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
    QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY i DESC) = 1
    """,
)
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return repair.summary(repair.edits(rows, gone="gone")).withColumnRenamed("conv", "conv_id")
