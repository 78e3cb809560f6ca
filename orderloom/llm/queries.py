"""One query per operator over its whole table, and the SQL twins of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    collocations,
    decontamination,
    exact_dedup,
    filter_audit,
    language_id,
    line_dedup,
    mixing,
    packing,
    quality,
    secrets,
    simhash_dedup,
    substring_dedup,
    toxicity,
)
from orderloom.llm.shared import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return toxicity.score_toxicity(table(spark, folder, "documents"), labels)


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = table(spark, folder, "benchmark")
    found = decontamination.contamination(table(spark, folder, "documents"), benchmark)
    listed = F.array_join(F.col("items").cast("array<string>"), ",")
    return found.withColumns({"items": listed, "similarity": F.round("similarity", 9)})


ORACLES["op2_decontamination"] = """
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
items AS (
    SELECT item_id, len(w) AS size, least(5, len(w)) AS width, w FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM benchmark) WHERE len(w) > 0),
item_shingles AS (
    SELECT item_id, size, width, array_to_string(w[i:i + width - 1], ' ') AS shingle, count(*) AS n
    FROM (SELECT *, unnest(range(1, size - width + 2)) AS i FROM items) GROUP BY ALL),
weights AS (
    SELECT width, shingle, 1.0::DOUBLE / count(*) AS weight FROM item_shingles GROUP BY ALL),
item_totals AS (
    SELECT item_id, sum(n * weight) AS total
    FROM item_shingles JOIN weights USING (width, shingle) GROUP BY item_id),
shingles AS (
    SELECT doc_id, width, words, i, array_to_string(w[i:i + width - 1], ' ') AS shingle
    FROM (SELECT doc_id, width, len(w) AS words, w, unnest(range(1, len(w) - width + 2)) AS i
          FROM texts, (SELECT DISTINCT width FROM items))),
hits AS (
    SELECT doc_id, width, words, i, item_id, size
    FROM shingles JOIN item_shingles USING (width, shingle)),
windows AS (
    SELECT DISTINCT doc_id, width, item_id, size,
        greatest(1, least(unnest([i, i + width - size]), words - size + 1)) AS begin FROM hits),
bags AS (
    SELECT doc_id, item_id, begin, shingle, coalesce(any_value(weight), 1.0) AS weight, count(*) AS n
    FROM windows v JOIN shingles s USING (doc_id, width)
    LEFT JOIN weights USING (width, shingle)
    WHERE s.i BETWEEN v.begin AND v.begin + v.size - v.width
    GROUP BY doc_id, item_id, begin, shingle),
compared AS (
    SELECT doc_id, item_id, begin, sum(b.n * weight) AS total,
        sum(least(b.n, coalesce(s.n, 0)) * weight) AS shared
    FROM bags b LEFT JOIN item_shingles s USING (item_id, shingle)
    GROUP BY doc_id, item_id, begin),
best AS (
    SELECT doc_id, item_id, max(shared / (compared.total + item_totals.total - shared)) AS similarity
    FROM compared JOIN item_totals USING (item_id) GROUP BY doc_id, item_id),
found AS (
    SELECT doc_id, string_agg(item_id, ',' ORDER BY item_id) AS items, max(similarity) AS similarity
    FROM best WHERE similarity >= 0.8 GROUP BY doc_id)
SELECT doc_id, items IS NOT NULL AS contaminated, coalesce(items, '') AS items,
    round(coalesce(similarity, 0.0), 9) AS similarity
FROM texts LEFT JOIN found USING (doc_id)
"""


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenized(table(spark, folder, "documents"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return quality.score_quality(table(spark, folder, "documents"), labels)


@query
def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


ORACLES["op6_exact_dedup"] = """
WITH t AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


@query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.counted(secrets.find_secrets(table(spark, folder, "documents")))


_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _located(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Matches with their starts: the lengths of all earlier matches and of the gaps up to them."""
    return f"""
    SELECT n, {rank} AS rank, '{kind}' AS kind, start, start + size AS stop FROM (
        SELECT n, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start,
            length(whole[i]) AS size, length(vals[i]) AS val
        FROM (SELECT n, whole, vals, gaps, unnest(range(1, len(whole) + 1)) AS i FROM (
            SELECT n, regexp_extract_all(body, '{pattern}') AS whole,
                regexp_extract_all(body, '{pattern}', {group}) AS vals,
                string_split_regex(body, '{pattern}') AS gaps
            FROM t)))
    WHERE val >= {least}"""


ORACLES["op8_secrets"] = f"""
WITH t AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents),
found AS ({_located("assign", 0, _ASSIGN, 2, 12)}
    UNION ALL {_located("access", 1, "AKIA[A-Z0-9]+", 0, 18)}
    UNION ALL {_located("hex", 2, "[0-9a-f]+", 0, 16)}),
lists AS (
    SELECT n, count(*) FILTER (kind = 'assign') AS n_assign,
        count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS spans
    FROM found GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM t LEFT JOIN lists USING (n)
"""


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    worded = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    lines = F.coalesce(F.size(worded), F.lit(0)).cast("long")
    left = line_dedup.drop_repeated_lines(docs.withColumn("n_lines", lines))
    return left.select(
        "doc_id",
        "n_lines",
        (F.col("n_lines") - lines).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLES["op9_line_dedup"] = """
WITH t AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
lines AS (
    SELECT doc_id, i, doc_id::HUGEINT * 1000000000 + i AS place, line,
        regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM t),
worded AS (
    SELECT *, row_number() OVER (PARTITION BY array_to_string(w, ' ') ORDER BY place) AS nth
    FROM lines WHERE len(w) > 0),
near AS (
    SELECT place, w, unnest(range(0, len(w) + 1)) AS p FROM worded WHERE nth = 1 AND len(w) >= 8),
keys AS (
    SELECT place, p, md5(CASE WHEN p = 0 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[1:p - 1] || w[p + 1:], ' ') END) AS variant FROM near),
partners AS (
    SELECT place, CASE WHEN p = 0 THEN min(place) OVER (PARTITION BY variant)
        ELSE least(min(place) FILTER (p = 0) OVER (PARTITION BY variant),
            min(place) OVER (PARTITION BY variant, p)) END AS earliest
    FROM keys),
gone AS (
    SELECT place FROM worded WHERE nth > 1
    UNION SELECT place FROM partners WHERE earliest < place)
SELECT doc_id, count(*) FILTER (len(w) > 0) AS n_lines,
    count(*) FILTER (place IN (SELECT place FROM gone)) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
        FILTER (place NOT IN (SELECT place FROM gone)), '')) AS kept_sha256
FROM lines GROUP BY doc_id
"""


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLES["op10_substring_dedup"] = """
WITH t AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t),
ranked AS (
    SELECT doc_id, i, row_number() OVER (
        PARTITION BY md5(array_to_string(w[i:i + 19], ' ')) ORDER BY doc_id, i) AS nth
    FROM starts),
gone AS (
    SELECT DISTINCT doc_id, p FROM (
        SELECT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE nth > 1)),
lists AS (SELECT doc_id, list(p) AS lost FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(lost), 0) AS n_removed,
    sha256(array_to_string(CASE WHEN lost IS NULL THEN w ELSE list_transform(
        list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(lost, p)), lambda p: w[p]) END, ' ')) AS kept_sha256
FROM t LEFT JOIN lists USING (doc_id)
"""


@query
def op11_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


# The mix takes the first words of each source's repeated stream, so a document's share of them is
# its overlap with as many rounds as the source may have.
ORACLES["op11_source_mixing"] = """
WITH d AS (
    SELECT row_number() OVER () AS serial, doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::HUGEINT AS size
    FROM documents),
s AS (
    SELECT source, sum(size)::HUGEINT AS n,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS w
    FROM d GROUP BY source),
o AS (
    SELECT *, sum(n) OVER () AS words, sum(w) OVER () AS weight,
        coalesce(sum(3 * n) OVER before, 0) AS limits, coalesce(sum(w) OVER before, 0) AS weights
    FROM s WINDOW before AS (ORDER BY 30 * n // w, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3 * n * (weight - weights) <= w * (words - limits) AS capped FROM o),
r AS (
    SELECT *, words - coalesce(sum(3 * n) FILTER (capped) OVER (), 0) AS free,
        weight - coalesce(sum(w) FILTER (capped) OVER (), 0) AS parts FROM c),
t AS (
    SELECT source, n::HUGEINT AS n,
        CASE WHEN capped THEN (3 * n)::DOUBLE ELSE (w * free)::DOUBLE / parts::DOUBLE END AS target,
        (CASE WHEN capped THEN 3 * n ELSE w * free // parts END)::HUGEINT AS share FROM r),
p AS (
    SELECT d.*, t.*, coalesce(sum(size) OVER (PARTITION BY d.source
        ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size, serial
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS place
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, target,
    (greatest(0, least(size, share - place)) + greatest(0, least(size, share - n - place))
        + greatest(0, least(size, share - 2 * n - place)))::BIGINT AS taken
FROM p
"""


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op12_collocations"] = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
places AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, 5) AS sizes(k))),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
    SELECT lang, phrase, k, f, cut, string_split(phrase, ' ') AS w
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM counts WHERE k >= 2)),
sides AS (
    SELECT c.lang, c.phrase, c.k, c.f AS a, cut, x.f AS l, y.f AS r,
        (2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f))::BIGINT AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
lowest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth
        FROM sides) WHERE nth = 1),
inside AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS cover FROM (
        SELECT lang, string_split(phrase, ' ') AS w, f, size, unnest(range(1, k - size + 2)) AS i
        FROM counts, range(2, 4) AS sizes(size) WHERE size < k) GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
    FROM lowest b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE cover IS NULL OR 100::HUGEINT * cover < 80::HUGEINT * a)
JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLES["op13_filter_audit"] = """
WITH t AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
worded AS (
    SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w,
        min(doc_id) OVER (PARTITION BY body) AS first FROM t),
failing AS (
    SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails FROM worded),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
    FROM labels GROUP BY doc_id),
sets AS (
    SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS before
    FROM orders, range(1, 6) AS numbers(step)),
judged AS (
    SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS fail,
        translate(fails, before, '') <> fails AS gone FROM sets, steps),
counted AS (
    SELECT part, filter_order, step, x, sum(n) FILTER (NOT gone AND NOT fail) AS kept,
        sum(n) FILTER (fail AND NOT gone) AS removed, sum(n) FILTER (fail AND gone) AS redundant,
        sum(n) FILTER (fails = x) AS unique_fails, sum(good) FILTER (fail AND NOT gone) AS good_lost,
        sum(toxic) FILTER (fail AND NOT gone) AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
    coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
    coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(coalesce(removed, 0)) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted
"""
