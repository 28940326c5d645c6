"""One query per operator over its whole table, and the SQL it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import chat, exact_dedup, mixing, ngram_join, packing, quality, repair, resampling, revisits, sharding, substring_dedup, tokenizer_files, toxicity, vector_search
from tidewright.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """DuckDB SQL for the CRC-32 of a text's UTF-8 bytes, byte by byte with the polynomial's table."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    found = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({found}, {step}, 4294967295::BIGINT), 4294967295)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op2_grace_hash_dedup",
    f"""WITH normal AS (SELECT doc_id, {LOWERED} AS content FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY content ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(content) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY content)""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


@query(
    "op3_super_k_mer_dedup",
    f"""WITH docs AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
windows AS (
    SELECT doc_id, first, array_to_string(words[first:first + 49], ' ') AS content
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS first FROM docs)
),
holders AS (SELECT content, min(doc_id) AS holder FROM windows GROUP BY content),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(first, first + 50)) AS place
    FROM windows JOIN holders USING (content) WHERE holder < doc_id
),
places AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM docs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS content, count(*) AS n
    FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(content, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.without_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op4_ngram_jaccard_join",
    f"""WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format(LOWERED)} AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[first:first + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS first FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT u, v FROM shared s JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
    WHERE 100 * s.n >= 75 * (a.n + b.n - s.n)
),
reached AS (
    SELECT doc_id AS start, doc_id AS reach FROM docs
    UNION
    SELECT start, v FROM reached JOIN links ON reach = u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN (SELECT start, min(reach) AS least FROM reached GROUP BY start) ON start = doc_id""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


@query(
    "op5_mix_sources",
    f"""WITH docs AS (SELECT doc_id, text, source, len({WORDS.format("coalesce(text, '')")})::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT source, source_size, (2 * source_size)::DOUBLE AS most,
           ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM totals
),
levels AS (
    SELECT *, row_number() OVER (ORDER BY most / weight, source) AS place,
           (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(most) OVER below, 0)) / sum(weight) OVER onward AS level
    FROM weighed
    WINDOW below AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           onward AS (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
settled AS (SELECT arg_min(level, place) AS level FROM levels WHERE NOT most < level * weight),
targets AS (
    SELECT w.source, source_size, CASE WHEN most < level * weight THEN most ELSE level * weight END AS target
    FROM weighed w, settled
),
rated AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS coin
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (coin < rate - floor(rate))::INT))::BIGINT AS taken FROM rated""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.mixed(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.placed(packing.pieces(docs, tokenizer_files.path("word_bpe_49k.json"), digest=True))


@query("op8_byte_network_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


@query("op9_trie_automata_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.judged(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


@query("op1_adaptive_dimension_search")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return vector_search.nearest(vectors, F.col("vec_id") % 50 == 0)


def _sql_escaped(text: str) -> str:
    out = "replace({}, '\\', '\\\\')".format(text)
    for control in chat.CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


@query(
    "op6_chat_masks",
    f"""WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))
),
whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
           sum(len({_sql_escaped("text")}) + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + len(role) END)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, len(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.formatted(turns.unionByName(more), tokenizer_files.path("byte_bpe_50k.json")))


# Captures made from pages: most pages are a full response; each is asked for again a little later, with the tag that it had
# (weak or strong), another one, or none.
_CAPTURES = """captures AS (
    SELECT 2 * page_id AS record_id, url, page_id AS time, true AS "full", md5(html) AS etag FROM pages WHERE page_id % 7 <> 3
    UNION ALL
    SELECT 2 * page_id + 1, 'HTTP://WWW.' || regexp_replace(url, '^https?://(www[.])?', '') || '#again', page_id + 1, false,
           CASE page_id % 5 WHEN 0 THEN 'W/' || md5(html) WHEN 1 THEN md5(url) WHEN 2 THEN NULL ELSE md5(html) END
    FROM pages
)"""


@query(
    "op7_not_modified_revisits",
    f"""WITH {_CAPTURES},
keyed AS (
    SELECT *, lower(regexp_extract(url, '{revisits.HOST}', 1)) || regexp_replace(regexp_extract(url, '{revisits.PATH}', 1), '/+$', '') AS page,
           regexp_replace(regexp_replace(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '{revisits.TRACKING}', '', 'g'), '^&', '') AS asked
    FROM captures
),
named AS (SELECT *, page || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END AS url_key FROM keyed),
tied AS (
    SELECT *, last_value(CASE WHEN "full" THEN struct_pack(id := record_id, tag := etag, date := time) END IGNORE NULLS) OVER (
               PARTITION BY url_key ORDER BY time, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
    FROM named
),
judged AS (
    SELECT *, CASE WHEN prior IS NULL THEN 'orphan'
                   WHEN etag IS NULL OR regexp_replace(etag, '^W/', '') = prior.tag THEN 'resolved' ELSE 'changed' END AS outcome
    FROM tied WHERE NOT "full"
)
SELECT record_id, url_key, outcome, CASE WHEN outcome = 'resolved' THEN prior.id END AS full_id,
       CASE WHEN outcome = 'resolved' THEN 'again ' || time END AS header_date,
       CASE WHEN outcome = 'resolved' THEN coalesce(etag, prior.tag) END AS header_etag,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END AS header_type,
       CASE WHEN outcome = 'resolved' THEN 'first ' || prior.date END AS header_server
FROM judged""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", F.md5("html").alias("tag"))
    page = F.col("page_id")
    asked = F.when(page % 5 == 0, F.concat(F.lit("W/"), "tag")).when(page % 5 == 1, F.md5("url")).when(page % 5 == 2, F.lit(None)).otherwise(F.col("tag"))
    late_url = F.concat(F.lit("HTTP://WWW."), F.regexp_replace("url", "^https?://(www[.])?", ""), F.lit("#again"))
    none = F.lit(None).cast("string")

    def record(number, url, time, full, etag, headers):
        filled = F.map_filter(F.create_map(*headers), lambda _, v: v.isNotNull())
        return F.struct(
            number.alias("record_id"), url.alias("url"), time.alias("time"), F.lit(full).alias("full"), etag.alias("etag"),
            none.alias("last_modified"), filled.alias("headers"),
        )

    def text(prefix, value):
        return F.concat(F.lit(prefix), value.cast("string"))

    first = record(2 * page, F.col("url"), page, True, F.col("tag"), [
        F.lit("content-type"), F.lit("text/html"), F.lit("etag"), F.col("tag"), F.lit("date"), text("first ", page), F.lit("server"), text("first ", page),
    ])
    again = record(2 * page + 1, late_url, page + 1, False, asked, [
        F.lit("content-type"), F.lit("none"), F.lit("etag"), asked, F.lit("date"), text("again ", page + 1), F.lit("server"), F.lit("again"),
    ])
    records = pages.select(F.explode(F.array(first, again)).alias("r")).select("r.*").filter("NOT full OR (record_id / 2) % 7 <> 3")
    found = revisits.resolved(records)
    header = lambda name, to: F.col("headers").getItem(name).alias(to)
    return found.select(
        "record_id", "url_key", "outcome", "full_id",
        header("date", "header_date"), header("etag", "header_etag"), header("content-type", "header_type"), header("server", "header_server"),
    )


@query(
    "op13_importance_resampling",
    f"""WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS place, regexp_extract_all({LOWERED}, '{resampling.WORD}') AS words FROM documents
    UNION ALL SELECT 'b', NULL, NULL, regexp_extract_all({LOWERED}, '{resampling.WORD}') FROM benchmark
),
features AS (
    SELECT kind, id, place, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM words
),
coded AS (SELECT feature, {_crc32("feature")} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM features)),
counted AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM features JOIN coded USING (feature) GROUP BY bucket),
gained AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted
),
summed AS (
    SELECT place, count(*) AS n, sum(gain)::BIGINT AS total FROM features JOIN coded USING (feature) JOIN gained USING (bucket)
    WHERE kind = 'd' GROUP BY place
),
scored AS (
    SELECT id AS doc_id, len(words) AS n_words, coalesce(n, 0) AS n_features,
           coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
           ('0x' || left(sha256('7:' || id::VARCHAR), 8))::BIGINT::DOUBLE AS h
    FROM words LEFT JOIN summed USING (place) WHERE kind = 'd'
),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM placed""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resampled(docs, read_table(spark, sf_dir, "benchmark"))


def _name_cell(name: str) -> str:
    """DuckDB SQL for the cell of a name, given the ends and the length of the common prefix of all."""
    number = "('0x' || rpad(hex(encode(substr({}, {name}_skip + 1, 6))), 12, '0'))::BIGINT"
    at, low, high = (number.format(x, name=name) for x in (f"least_{name}", f"{name}_min", f"{name}_max"))
    cell = f"1 + floor(({at} - {low})::DOUBLE / greatest(1, {high} - {low})::DOUBLE * {sharding.CELLS - 2})"
    return f"CASE WHEN least_{name} IS NULL THEN 0 ELSE greatest(1, least({sharding.CELLS - 1}, {cell})) END::INT"


def _tree_level(k: int, half: int) -> str:
    """One level of the k-d tree: rows r{k} of nodes with 2 * half leaves each go to their children in r{k + 1}."""
    return f"""s{k} AS (
    SELECT node, dim, cell, sum(size) AS weight FROM (SELECT node, size, unnest([0, 1, 2]) AS dim, unnest([dim0, dim1, dim2]) AS cell FROM r{k}) GROUP BY ALL
),
w{k} AS (
    SELECT node, arg_max(dim, 3 * width - dim) AS dim, any_value(total) / 2 AS goal
    FROM (SELECT node, dim, max(cell) - min(cell) AS width, sum(weight)::DOUBLE AS total FROM s{k} GROUP BY node, dim) GROUP BY node
),
m{k} AS (
    SELECT node, dim, goal, cell, upto - weight AS before
    FROM (SELECT *, sum(weight) OVER (PARTITION BY node ORDER BY cell) AS upto FROM s{k} JOIN w{k} USING (node, dim))
    WHERE upto >= goal QUALIFY row_number() OVER (PARTITION BY node ORDER BY cell) = 1
),
p{k} AS (
    SELECT node, dim, goal, cell, place, sum(size) AS weight, before + sum(sum(size)) OVER (PARTITION BY node ORDER BY place) AS upto
    FROM r{k} JOIN m{k} USING (node) WHERE ([dim0, dim1, dim2])[dim + 1] = cell GROUP BY node, dim, goal, cell, place, before
),
c{k} AS (
    SELECT node, dim, cell, CASE WHEN upto - goal <= goal - upto + weight THEN place ELSE place - 1 END AS last
    FROM p{k} WHERE upto >= goal QUALIFY row_number() OVER (PARTITION BY node ORDER BY place) = 1
),
r{k + 1} AS (
    SELECT r.* REPLACE (node + CASE WHEN (([dim0, dim1, dim2])[dim + 1], place) > (cell, last) THEN {half} ELSE 0 END AS node)
    FROM r{k} r JOIN c{k} USING (node)
),
"""


@query(
    "op12_kd_tree_sharding",
    f"""WITH measured AS (
    SELECT doc_id, source, lang, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32, left(md5(coalesce(text, '')), 16) AS hash
    FROM documents
),
bounds AS (
    SELECT sum(size) AS bytes, max(size) AS most, min(source) AS source_min, max(source) AS source_max, min(lang) AS lang_min, max(lang) AS lang_max FROM measured
),
ends AS (
    SELECT *, len(list_filter(range(1, len(source_min) + 1), lambda i: left(source_min, i) = left(source_max, i))) AS source_skip,
           len(list_filter(range(1, len(lang_min) + 1), lambda i: left(lang_min, i) = left(lang_max, i))) AS lang_skip
    FROM bounds
),
grouped AS (
    SELECT *, count(*) OVER same AS n, sum(size) OVER same AS group_bytes, min(source) OVER same AS least_source, min(lang) OVER same AS least_lang
    FROM measured WINDOW same AS (PARTITION BY hash)
),
spots AS (
    SELECT *, CASE WHEN n > 1 AND group_bytes > {sharding.WHOLE}::DOUBLE * bytes / 16 THEN left(md5(concat_ws(':', hash, doc_id)), 16) ELSE hash END AS spot
    FROM grouped, ends
),
r0 AS (
    SELECT doc_id, size, text_crc32, spot, ('0x' || left(spot, 4))::INT AS place, {_name_cell("source")} AS dim0, {_name_cell("lang")} AS dim1,
           floor(ln(size::DOUBLE) / ln(greatest(2, most)::DOUBLE) * {sharding.CELLS - 1})::INT AS dim2, 0 AS node
    FROM spots
),
{"".join(_tree_level(k, 8 >> k) for k in range(4))}numbers AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY spot, doc_id) - 1 AS slot FROM r4)
SELECT doc_id, size, text_crc32, 'bytes' AS law, node AS shard, slot, NULL::INT AS grown_shard FROM numbers""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(read_table(spark, sf_dir, "documents"), shards=16)


@query(
    "op11_survivor_viterbi_repair",
    f"""WITH RECURSIVE coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code
    FROM conversations
),
rows AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS nth
    FROM coded WHERE code <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), nth) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, nth) AS seen,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
    FROM rows
),
judged AS (
    SELECT *, left(role, 1) AS initial, CASE WHEN shown = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(shown, '[.!?]$') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS initial_before
    FROM placed
),
inserted(state, inserts, stands) AS (  -- states: 0 nothing yet, 1 s, 2 u, 3 a
    VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)
),
names AS (SELECT DISTINCT conv_id FROM conversations),
best(conv_id, i, state, way) AS (
    SELECT conv_id, 0::BIGINT, 0, struct_pack(cost := 0::BIGINT, audit := '') FROM names
    UNION ALL
    SELECT conv_id, i, state, min(way) FROM (
        SELECT b.conv_id, j.i, e.to_state AS state, struct_pack(cost := b.way.cost + 3 * len(n.inserts) + e.cost, audit := b.way.audit || n.inserts || e.edit) AS way
        FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i + 1 JOIN inserted n ON n.state = b.state,
        LATERAL (
            SELECT 'D' AS edit, n.stands AS to_state, 4 AS cost
            UNION ALL SELECT 'K', 1, CASE WHEN j.fault = 'truncated' THEN 3 ELSE 0 END WHERE n.stands = 0 AND j.initial = 's' AND j.fault NOT IN ('blank', 'duplicate')
            UNION ALL SELECT 'K', CASE n.stands WHEN 2 THEN 3 ELSE 2 END, CASE WHEN j.fault = 'truncated' THEN 3 ELSE 0 END
                      WHERE j.initial = CASE n.stands WHEN 2 THEN 'a' ELSE 'u' END AND j.fault NOT IN ('blank', 'duplicate')
            UNION ALL SELECT 'R', CASE n.stands WHEN 2 THEN 3 ELSE 2 END, CASE WHEN j.fault = 'truncated' THEN 6 ELSE 3 END WHERE j.fault NOT IN ('blank', 'duplicate')
        ) e
    ) GROUP BY conv_id, i, state
),
lengths AS (SELECT conv_id, count(*) AS n FROM judged GROUP BY conv_id),
ended AS (
    SELECT b.conv_id, min(struct_pack(cost := way.cost + 3 * len(inserts), audit := way.audit || inserts)) AS way
    FROM best b LEFT JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM b.conv_id JOIN inserted n USING (state)
    WHERE b.i = coalesce(l.n, 0) AND (n.stands = 3 OR n.stands = 0) GROUP BY b.conv_id
),
letters AS (
    SELECT conv_id, k, way.audit[k] AS letter, len(replace(left(way.audit, k), 'I', '')) AS i,
           len(replace(left(way.audit, k), 'D', '')) AS place, len(replace(way.audit, 'D', '')) AS n
    FROM (SELECT conv_id, way, unnest(range(1, len(way.audit) + 1)) AS k FROM ended)
),
kept AS (
    SELECT l.conv_id, place, CASE WHEN letter = 'K' THEN role WHEN (n - place) % 2 = 1 THEN 'user' ELSE 'assistant' END AS role, CASE WHEN letter = 'I' THEN '' ELSE text END AS text
    FROM letters l LEFT JOIN judged j ON letter <> 'I' AND j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i WHERE letter <> 'D'
),
texts AS (SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY place) AS content FROM kept GROUP BY conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, way.cost AS cost, way.audit AS audit, sha256(coalesce(content, '')) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM e.conv_id""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.audited(repair.edits(repair.damaged(turns), turns))
