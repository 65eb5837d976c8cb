"""The registered queries of this folder with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (html_main_text, jaccard_join, merkle_manifest, mixing, neighbour_votes, periodic_runs, permutation_index, quality_rules,
               quotation_links, sentence_pieces, sharding, suffix_tree_lm, url_filters)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn
    return register


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_rules_sql(risk: float = 0.01, error: float = 0.05) -> str:
    rules = quality_rules.RULES
    steps = quality_rules.STEPS
    ratios = " UNION ALL ".join(f"SELECT doc_id, lang, '{r}' AS rule, {a} AS a, {b} AS b, {cs[:steps]}::BIGINT[] AS cutoffs, base_failed FROM counts"
                                for r, (a, b, cs) in rules.items())
    upper = "translate(chars, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')"
    return rf"""WITH base AS (SELECT doc_id, lang, {WORDS_SQL} AS w, list_filter(string_split(coalesce(text, ''), chr(10)),
    lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS chars FROM documents),
windows AS (SELECT doc_id, lang, unnest(range(1, len(w) - 1)) AS p, w FROM base WHERE len(w) > 3),
grams AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM windows),
spans AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
repeats AS (SELECT doc_id, sum(least(3, p - coalesce(before, -3))) AS n FROM spans GROUP BY doc_id),
sized AS (SELECT base.doc_id, lang, len(w) AS n_words, length(chars) AS word_chars,
    length(chars) - length(regexp_replace(chars, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, length(chars) - length({upper}) AS n_capitals
    FROM base LEFT JOIN repeats USING (doc_id)),
counts AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM sized),
ratios AS ({ratios}),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT doc_id, lang, max(len(list_filter(cutoffs, lambda c: 1000 * a > c * b))) AS over FROM ratios
    WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY doc_id, lang),
tests AS (SELECT lang, step, count(*) AS n, count(*) FILTER (over > step) AS k FROM held, range({steps}) t(step) GROUP BY lang, step),
tails AS (SELECT *, CASE WHEN k >= n * {risk} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) END AS tail FROM tests),
certified AS (SELECT lang, min(step) AS step FROM tails WHERE tail <= {error} / (SELECT count(DISTINCT coalesce(lang, '')) FROM held) GROUP BY lang),
broken AS (SELECT doc_id, array_agg(DISTINCT rule ORDER BY rule) AS rules FROM ratios JOIN certified ON ratios.lang IS NOT DISTINCT FROM certified.lang
    WHERE 1000 * a > cutoffs[step + 1] * b GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND rules IS NULL AS kept, array_to_string(coalesce(rules, []), ',') AS broken_rules
FROM counts LEFT JOIN broken USING (doc_id)"""


@query(_quality_rules_sql())
def op9_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", F.array_join(F.sort_array("broken_rules"), ",").alias("broken_rules"))


#: fixed values: the rules that the query judges by
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_FITS = " UNION ALL ".join(
    f"SELECT url, host, path, '{h}{p}' AS rule, '{a}' AS action FROM parts WHERE (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')"
    for h, p, a in URL_RULES)


@query(f"""WITH rest AS (SELECT DISTINCT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT url, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT url, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cut),
best AS (SELECT url, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM ({_FITS}) GROUP BY url)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM pages
JOIN parts ON pages.url IS NOT DISTINCT FROM parts.url LEFT JOIN best ON pages.url IS NOT DISTINCT FROM best.url""")
def op5_url_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


@query(rf"""WITH sized AS (SELECT doc_id, source, len({WORDS_SQL}) AS size, md5(coalesce(text, '')) AS digest,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS symbols FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size) AS cap,
    ([5.0::DOUBLE, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS share FROM sized GROUP BY source),
filled AS (SELECT cap / share AS top, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / share, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(share) OVER (ORDER BY cap / share, source
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares FROM sources),
level AS (SELECT min(rest / shares) AS level FROM (SELECT *, row_number() OVER (ORDER BY top, rest DESC) AS k FROM filled WHERE rest / shares <= top) WHERE k = 1),
targets AS (SELECT source, source_size, least(cap, share * level) AS target FROM sources, level),
goals AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
keyed AS (SELECT doc_id, source, size, -ln((('0x' || substr(md5('0|' || doc_id || '|' || substr(digest, 1, 16)), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296.0::DOUBLE) / greatest(0.25::DOUBLE, (size + 1)::DOUBLE / (size + 1 + 10 * symbols)) AS key FROM sized),
running AS (SELECT keyed.*, source_size, target, epochs, target - epochs * source_size AS budget,
    sum(size) OVER (PARTITION BY keyed.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS fin
    FROM keyed JOIN goals ON keyed.source IS NOT DISTINCT FROM goals.source),
chosen AS (SELECT *, (epochs + (fin - size < budget AND (fin <= budget OR fin - budget < budget - (fin - size)))::INTEGER)::INTEGER AS copies FROM running)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM chosen""")
def op6_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query()
def op8_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(table(spark, sf_dir, "documents"))


@query()
def op10_shingle_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(table(spark, sf_dir, "documents"), width=4, percent=85)


@query()
def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "tokens")


@query()
def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"))


@query()
def op4_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = neighbour_votes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def quoting_mail(conversations: DataFrame) -> DataFrame:
    """The conversations as mail threads: each message quotes the one before, and above it the one before that, one level deeper."""
    texts = conversations.groupBy("conv_id", "turn").agg(F.max("text").alias("text"))

    def earlier(n: int) -> DataFrame:
        return texts.select("conv_id", (F.col("turn") + n).alias("turn"), F.regexp_replace("text", r"(?m)^", ">" * n + " ").alias(f"q{n}"))

    return (conversations.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", F.concat_ws("\n", "q2", "q1", "text").alias("text")))


@query(r"""WITH lines AS (SELECT DISTINCT conv_id, turn, lower(l) AS l FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS l FROM conversations)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
sizes AS (SELECT conv_id, turn, count(*) AS n FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS l FROM conversations)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY ALL),
linked AS (SELECT c.conv_id, c.turn, role, text, p.n AS n1, g.n AS n2 FROM conversations c
    LEFT JOIN sizes p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 LEFT JOIN sizes g ON g.conv_id = c.conv_id AND g.turn = c.turn - 2)
SELECT conv_id, turn, role, text, CASE WHEN n1 > 0 THEN turn - 1 END AS reply_to, min(turn) OVER (PARTITION BY conv_id) AS thread,
  (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS position,
  CASE WHEN n2 > 0 THEN 2 WHEN n1 > 0 THEN 1 ELSE 0 END AS quote_levels, (coalesce(n1, 0) + coalesce(n2, 0))::BIGINT AS quoted_lines,
  (coalesce(n1, 0) + coalesce(n2, 0))::BIGINT AS linked_lines FROM linked""")
def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_links.link(quoting_mail(table(spark, sf_dir, "conversations")))


#: a public BPE vocabulary with byte fallback; the path is a parameter of the operator
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query()
def op7_max_plus_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = sentence_pieces.encode(docs.select("doc_id", "text"), PIECES)
    decoded = sentence_pieces.decode(pieces, PIECES)
    return decoded.select(F.col("key").alias("doc_id"), F.size("pieces").cast("long").alias("n_pieces"), "pieces",
                          F.xxhash64("pieces").alias("pieces_hash"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


@query()
def op11_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.made_periodic("doc_id", "text").alias("text"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs, carry=["doc_id"]))


def _merkle_sql(width: int = 8, inner: int = 8, top: int = 8) -> str:
    """Levels one by one: enough for ``width ** inner`` rows of a language and ``width ** top`` languages."""
    crc = """xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*(field(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""WITH leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS changed FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
a0 AS (SELECT lang, r, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM numbered),
p0 AS (SELECT doc_id, lang, r, leaf, coalesce(changed, leaf) AS x, '' AS proof FROM numbered)"""]

    def climb(a: str, p: str, key: str, rank: str, levels: int) -> None:
        for k in range(levels):
            of = f"PARTITION BY {key}, r // {width}"
            parts.append(f"""{a}s{k} AS (SELECT {key}, r, d, n, coalesce(string_agg(d, '') OVER ({of} ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(d, '') OVER ({of} ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS e FROM {a}{k}),
{a}{k + 1} AS (SELECT {key}, r // {width} AS r, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY r)) END AS d, ceil(max(n) / {width})::BIGINT AS n
  FROM {a}{k} GROUP BY {key}, r // {width}),
{p}{k + 1} AS (SELECT p.* REPLACE (CASE WHEN s.n = 1 THEN p.x ELSE sha256(s.b || p.x || s.e) END AS x, CASE WHEN s.n = 1 THEN p.proof ELSE p.proof || s.b || s.e END AS proof)
  FROM {p}{k} p JOIN {a}s{k} s ON p.{key} IS NOT DISTINCT FROM s.{key} AND p.{rank} // {width ** k} = s.r)""")

    climb("a", "p", "lang", "r", inner)
    parts.append(f"""b0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, lang, d, count(*) OVER () AS n FROM a{inner}),
q0 AS (SELECT p.*, b0.r AS t, b0.d AS subroot, 0 AS one FROM p{inner} p JOIN b0 ON p.lang IS NOT DISTINCT FROM b0.lang)""")
    climb("b", "q", "one", "t", top)
    return ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = d AS verified FROM q{top}, b{top}"""


@query(_merkle_sql(inner=6, top=2))
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.document_manifest(table(spark, sf_dir, "documents"))


# the given pages mark their article; there the rules come down to its blocks
@query(r"""WITH cut AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)<footer>', 1, 's'),
    '</?(p|h1|article)>', chr(10), 'g'), '<[^>]*>', ' ', 'g'), chr(10)) AS lines FROM pages),
decoded AS (SELECT page_id, url, list_filter(list_transform(lines, lambda l: trim(regexp_replace(regexp_replace(replace(l, '&quot;', '"'),
    '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda l: l <> '') AS blocks FROM cut),
joined AS (SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text FROM decoded)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined""")
def op13_two_pass_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
