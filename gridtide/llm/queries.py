"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm import bpe, leaks, licenses, lm, neardup, periodic, prefixes, quality, repeats, shards, toxicity, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str):
    def add(make):
        QUERIES[name] = make
        return make

    return add


@query("op6_substring_dedup")
def _(spark, folder):
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op6_substring_dedup"] = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 12], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS pos FROM split)
), firsts AS (
  SELECT seq, min(doc_id) AS first_doc FROM windows GROUP BY seq
), gone AS (
  SELECT doc_id, list(DISTINCT pos + o) AS spots
  FROM (SELECT w.doc_id, w.pos FROM windows w JOIN firsts f USING (seq) WHERE f.first_doc < w.doc_id), range(13) r(o)
  GROUP BY doc_id
), kept AS (
  SELECT s.doc_id, len(w) AS n_words, coalesce(len(g.spots), 0) AS n_removed,
    list_filter(w, lambda x, i: NOT coalesce(list_contains(g.spots, i), false)) AS rest
  FROM split s LEFT JOIN gone g USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept
"""


@query("op8_quality_rules")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.judge(docs, model).drop("text")


@query("op3_bpe")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, decoded="decoded_text")
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded_text", 256).alias("decoded_sha256")
    )


@query("op10_minhash_near_dedup")
def _(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


ORACLE["op10_minhash_near_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM split WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@query("op7_benchmark_decontamination")
def _(spark, folder):
    found = leaks.find_leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select("doc_id", F.inline("leaks")).withColumnRenamed("item", "item_id")


@query("op1_license_scan")
def _(spark, folder):
    return licenses.scan(table(spark, folder, "documents").select("doc_id", "text")).drop("matches")


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(
    f"({i}, {_sql(label)}, [{', '.join(_sql(w) for w in sorted(set(licenses.words_of(text))))}], [{', '.join(_sql(w) for w in licenses.words_of(named))}])" for i, (label, text, named) in enumerate(licenses.TEMPLATES)
)
_PHRASE_ROWS = ", ".join(f"({_sql(label)}, {_sql(phrase)}, {len(phrase.split())})" for phrase, label in licenses.PHRASES.items())
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LONGEST = max(len(licenses.words_of(text)) for _, text, _ in licenses.TEMPLATES)
ORACLE["op1_license_scan"] = rf"""
WITH templates(template, label, words, named) AS (VALUES {_TEMPLATE_ROWS}
), phrases(label, phrase, n) AS (VALUES {_PHRASE_ROWS}
), docs AS (
  SELECT doc_id, {_LOWER} AS low, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, label, pos - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM docs) CROSS JOIN phrases
  WHERE array_to_string(w[pos:pos + n - 1], ' ') = phrase
), base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS base FROM places GROUP BY doc_id
), numbered AS (
  SELECT doc_id, all_w, i, len(regexp_extract_all(parts[i], '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS n
  FROM (SELECT doc_id, all_w, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, w AS all_w, string_split(low, chr(10)) AS parts FROM docs))
), ended AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS e FROM numbered
), lines AS (SELECT doc_id, i, list_distinct(all_w[e - n + 1:e + {_LONGEST - 1}]) AS w FROM ended WHERE n > 0
), met AS (
  SELECT doc_id, i, label, named, len(list_intersect(w, words)) / len(words) AS share FROM lines CROSS JOIN templates
  WHERE len(list_intersect(w, words)) >= ceil({licenses.CONTAINED} * len(words) - 1e-9) AND list_has_all(w, named)
), found AS (
  SELECT * FROM met x WHERE NOT EXISTS (SELECT 1 FROM met y WHERE y.doc_id = x.doc_id AND y.i = x.i AND len(y.named) > len(x.named) AND list_has_all(y.named, x.named))
), best AS (SELECT doc_id, max(share) AS share, list(DISTINCT label) AS more FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM docs d LEFT JOIN base b ON b.doc_id = d.doc_id LEFT JOIN best x ON x.doc_id = d.doc_id
"""


def captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: the fetch day follows from the page id, because the table has none."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(365)).cast("int")).alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts that the pages have; which of them are listed, and when, follows from a hash."""
    host = urls.host_of(F.col("url"))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", 1)
    hosts = pages.select(host.alias("host"), path.alias("path")).distinct().filter("host IS NOT NULL")
    pair = lambda kind, pattern: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))
    prefix = F.when(F.col("path") != "", F.concat("host", F.lit("/"), "path"))
    kinds = hosts.select(F.inline(F.array(pair("host", F.col("host")), pair("domain", F.substring_index("host", ".", -3)), pair("prefix", prefix))))
    kinds = kinds.filter("pattern IS NOT NULL").distinct()
    number = lambda at: F.conv(F.substring(F.md5(F.concat_ws("|", "kind", "pattern")), at, 6), 16, 10).cast("long")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    dated = kinds.withColumns({"a": number(1), "b": number(7), "c": number(13)}).filter("a % 3 = 0")
    start, stop = F.pmod("b", F.lit(300)), F.pmod("b", F.lit(300)) + 1 + F.pmod("c", F.lit(90))
    category = F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (F.pmod("c", F.lit(3)) + 1).cast("int"))
    change = lambda action, at: F.struct(F.lit(action).alias("action"), day(at).alias("listed_at"))
    changes = F.array(change("add", start), F.when(F.col("a") % 2 == 0, change("remove", stop)), F.when(F.col("a") % 4 == 0, change("add", stop + 20)))
    return dated.select("kind", "pattern", category.alias("category"), F.inline(F.filter(changes, lambda x: x.isNotNull())))


@query("op9_url_filter")
def _(spark, folder):
    pages = table(spark, folder, "pages")
    return urls.judge(captures(pages), list_entries(pages))


ORACLE["op9_url_filter"] = r"""
WITH page AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id % 365)::INTEGER AS fetched,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)', 1) AS path
  FROM pages
), kinds AS (
  SELECT DISTINCT kind, pattern FROM (
    SELECT 'host' AS kind, host AS pattern FROM page
    UNION ALL SELECT 'domain', array_to_string(string_split(host, '.')[-3:], '.') FROM page
    UNION ALL SELECT 'prefix', CASE WHEN path <> '' THEN host || '/' || path END FROM page
  ) WHERE pattern IS NOT NULL
), hashed AS (SELECT kind, pattern, md5(kind || '|' || pattern) AS h FROM kinds
), dated AS (
  SELECT kind, pattern, ('0x' || substr(h, 1, 6))::BIGINT AS a, ('0x' || substr(h, 7, 6))::BIGINT AS b, ('0x' || substr(h, 13, 6))::BIGINT AS c FROM hashed
), listed AS (
  SELECT kind, pattern, ['adult', 'malware', 'spam'][c % 3 + 1] AS category, a, (b % 300)::INTEGER AS start, (b % 300 + 1 + c % 90)::INTEGER AS stop FROM dated WHERE a % 3 = 0
), held AS (
  SELECT kind, pattern, category, DATE '2024-01-01' + start AS valid_from, CASE WHEN a % 2 = 0 THEN DATE '2024-01-01' + stop END AS valid_to FROM listed
  UNION ALL SELECT kind, pattern, category, DATE '2024-01-01' + (stop + 20), NULL FROM listed WHERE a % 4 = 0
), hits AS (
  SELECT p.page_id, h.* FROM page p JOIN held h ON p.fetched >= h.valid_from AND (h.valid_to IS NULL OR p.fetched < h.valid_to)
    AND CASE h.kind WHEN 'host' THEN p.host = h.pattern WHEN 'domain' THEN p.host = h.pattern OR ends_with(p.host, '.' || h.pattern)
      ELSE p.path <> '' AND p.host || '/' || p.path = h.pattern END
), best AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, category, kind, pattern) AS place, count(*) OVER (PARTITION BY page_id) AS n FROM hits
)
SELECT p.page_id, p.url, p.fetched, p.host, b.n IS NOT NULL AS blocked, coalesce(b.n, 0)::BIGINT AS n_active, b.kind, b.pattern, b.category, b.valid_from AS active_since
FROM page p LEFT JOIN best b ON b.page_id = p.page_id AND b.place = 1
"""


@query("op2_balanced_shards")
def _(spark, folder):
    return shards.assign(table(spark, folder, "documents").select("doc_id", "text"))


@query("op4_lm_score")
def _(spark, folder):
    return lm.score(table(spark, folder, "documents").select("doc_id", "text"))


@query("op5_toxicity")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % toxicity.MODULUS == toxicity.HELD
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def with_loops(docs: DataFrame) -> DataFrame:
    """The documents' words; in every tenth, by a hash of the id, those from a place on repeat a few of them (as the query is stated)."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = docs.withColumns({"h": h, "w": F.when(h % 10 == 0, words)}).withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("w").cast("long")})
    placed = picked.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    looped = F.expr("array_join(transform(sequence(0L, n - 1), i -> w[CAST(IF(i < a, i, a + (i - a) % p) AS INT)]), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def _(spark, folder):
    found = periodic.find_runs(with_loops(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = F.col("best_run")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best_run.length div best_run.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


# CRC-32 of a decimal number's digits, unsigned: bit by bit, because DuckDB has no such function.
def _crc32(number: str) -> str:
    step = "list_reduce([xor(crc, b)] || range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))"
    return f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({number}::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda crc, b: {step}), 4294967295)"


ORACLE["op13_periodic_runs"] = rf"""
WITH split AS (
  SELECT doc_id, {_crc32('doc_id')} AS h, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS o FROM documents
), placed AS (SELECT doc_id, o, len(o) AS n, h % 10 = 0 AND len(o) > 0 AS looped, (h // 10) % greatest(len(o), 1) AS a, 3 + (h // 10) % 8 AS k FROM split
), docs AS (
  SELECT doc_id, n, CASE WHEN looped THEN list_transform(range(n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END]) ELSE o END AS w FROM placed
), words AS MATERIALIZED (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM docs
), pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= (SELECT n FROM docs d WHERE d.doc_id = x.doc_id)
), islands AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island HAVING max(i) + 1 + q - min(i) >= greatest(24, 3 * q)
), runs AS MATERIALIZED (
  SELECT doc_id, s, e - s AS len, q FROM islands x WHERE NOT EXISTS (SELECT 1 FROM islands y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.e >= x.e)
), gone AS (
  SELECT doc_id, list(DISTINCT i) AS spots FROM (SELECT doc_id, unnest(range(s + q, s + len)) AS i FROM runs) GROUP BY doc_id
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len::HUGEINT * 1000000000000 // q DESC, s, q) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.len::BIGINT AS length, b.q::BIGINT AS period, (1000 * b.len // b.q)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(g.spots, i - 1), false)), ' ')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN gone g USING (doc_id)
"""


@query("op11_warc_index")
def _(spark, folder):
    pages = table(spark, folder, "pages")
    archive = warc.write_archives(pages)
    wanted = pages.select("page_id", warc.url_key("url").alias("key")).distinct()
    found = warc.read_records(archive, warc.lookup(archive, wanted, "key", "page_id"), payload=False)
    record = F.col("record")
    return found.select(
        "page_id", record["payload_bytes"].alias("payload_bytes"), record["payload_digest"].alias("payload_digest"), record["record_type"].alias("record_type"),
        F.url_decode(record["refers_to"]).cast("long").alias("refers_to"),
    )


ORACLE["op11_warc_index"] = """
WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages
), last AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS kept, strlen(body) AS size FROM page
), judged AS (SELECT *, size >= 1000 AND page_id < kept AS again FROM last)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(body) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN kept END::BIGINT AS refers_to
FROM judged
"""


@query("op12_prefix_trie")
def _(spark, folder):
    head = lambda c: F.crc32(c.cast("string").cast("binary")) % 9
    return prefixes.build_trie(table(spark, folder, "conversations"), lambda c: c - c % 5, head).drop("n_ends")


ORACLE["op12_prefix_trie"] = rf"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (SELECT conv_id, t, conv_id - conv_id % 5 AS base, {_crc32('conv_id')} % 9 AS h FROM own
), rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.t[1:h], []), o.t[h + 1:]) AS t FROM headed o LEFT JOIN own b ON b.conv_id = o.base
), members AS MATERIALIZED (
  SELECT conv_id, d, to_json(t[1:d])::VARCHAR AS seq, CASE WHEN d > 0 THEN to_json(t[1:d - 1])::VARCHAR END AS up, CASE WHEN d > 0 THEN strlen(t[d].text) ELSE 0 END AS bytes, d = len(t) AS last
  FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM rebuilt)
), nodes AS MATERIALIZED (
  SELECT seq, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own_saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM members GROUP BY seq
), children AS (SELECT up AS seq, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
), sums AS (
  SELECT m.seq, sum(n.own_saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.d <= n.depth LEFT JOIN children c ON c.seq = n.seq GROUP BY m.seq
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.seq = n.up LEFT JOIN children c ON c.seq = n.seq JOIN sums s ON s.seq = n.seq
"""
