"""One query per operator over its whole table, and DuckDB equivalents where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.llm import (
    decontaminate, language, lexical, lines, mixing, ngram_join, pii, prefix_trie, quality, secrets,
    simhash, substring, url_rules,
)
from meterflow.llm.shared import table

URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
]

# Targets of the mix: sources belong to domains, the rest is "other".
DOMAINS = {
    "web": ["src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7"],
    "books": ["src8", "src9", "src10", "src11", "src12"],
    "reference": ["src13", "src14", "src15"],
}
MIX = mixing.Mix(
    domains={"web": 40, "books": 30, "reference": 25, "other": 5},
    langs={"en": 6, "de": 2, "fr": 2}, sources={"src0": 3}, budget_percent=60, max_epochs=3,
    seed=17)
PSEUDONYM_KEY = b"an example key; production passes its own"


def domain():
    chain = F.lit("other")
    for name, sources in DOMAINS.items():
        chain = F.when(F.col("source").isin(sources), name).otherwise(chain)
    return chain


def op1_decontaminate(spark, sf_dir):
    return decontaminate.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_equal")


def op2_line_dedup(spark, sf_dir):
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op3_language_id(spark, sf_dir):
    model = language.TextModel.fit(table(spark, sf_dir, "documents"))
    return language.identify(table(spark, sf_dir, "pages"), model)


def op4_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


def op5_pii_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op6_substring_dedup(spark, sf_dir):
    return substring.dedup(table(spark, sf_dir, "documents"), with_text=False)


def op7_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_simhash(spark, sf_dir):
    return simhash.components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_mixing(spark, sf_dir):
    return mixing.select_mix(table(spark, sf_dir, "documents"), domain(), MIX)


def op10_quality_rules(spark, sf_dir):
    return quality.judge(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ngram_join(spark, sf_dir):
    return ngram_join.components(table(spark, sf_dir, "documents"))


def _sql_weight(name: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"WHEN {name} = '{value}' THEN {weight}" for value, weight in weights.items())
    return f"CASE {cases} ELSE 1 END" if cases else "1"


def _sql_level(number: int) -> str:
    """One level of the share-out: budgets of the children from those of their parents."""
    keys = mixing.LEVELS[: number + 1]
    parent, name = ", ".join(keys[:-1]), keys[-1]
    weights = (MIX.domains, MIX.langs, MIX.sources)[number]
    by = f"PARTITION BY {parent} " if parent else ""
    above = f"JOIN level{number - 1} above USING ({parent})" if parent else "CROSS JOIN root above"
    return f"""
        supply{number} AS (
            SELECT {", ".join(keys)}, sum(tokens) * {MIX.max_epochs} AS supply,
                {_sql_weight(name, weights)} AS weight
            FROM leaves GROUP BY {", ".join(keys)}),
        placed{number} AS (
            SELECT *, coalesce(sum(supply) OVER ({by}ORDER BY supply / weight, {name}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                sum(weight) OVER ({by}ORDER BY supply / weight, {name}
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
            FROM (SELECT s.*, above.budget AS parent_budget FROM supply{number} s {above}) x),
        filled{number} AS (
            SELECT *, CAST(supply AS HUGEINT) * CAST(rest AS HUGEINT)
                <= CAST(greatest(parent_budget - before, 0) AS HUGEINT) * weight AS filled
            FROM placed{number}),
        level{number} AS (
            SELECT {", ".join(keys)}, supply, CASE WHEN filled THEN supply ELSE
                (CAST(parent_budget - coalesce(sum(CASE WHEN filled THEN supply END) OVER ({by}), 0)
                    AS HUGEINT) * weight)
                // CAST(sum(CASE WHEN NOT filled THEN weight END) OVER ({by}) AS HUGEINT)
                END AS budget
            FROM filled{number})"""


def _mixing_sql() -> str:
    names = " ".join(
        "WHEN source IN ({}) THEN '{}'".format(", ".join(f"'{s}'" for s in sources), name)
        for name, sources in DOMAINS.items())
    keys = ", ".join(mixing.LEVELS)
    return rf"""
        WITH counted AS (
            SELECT doc_id, CASE {names} ELSE 'other' END AS domain, coalesce(lang, '') AS lang,
                coalesce(source, '') AS source,
                len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n_tokens
            FROM documents),
        leaves AS (
            SELECT {keys}, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted
            WHERE n_tokens > 0 GROUP BY {keys}),
        root AS (SELECT sum(tokens) * {MIX.budget_percent} // 100 AS budget FROM leaves),
        {",".join(_sql_level(number) for number in range(3))},
        shares AS (
            SELECT {keys}, CAST(budget // (supply // {MIX.max_epochs}) AS BIGINT) AS epochs,
                CAST(budget % (supply // {MIX.max_epochs}) AS BIGINT) AS tail
            FROM level2),
        drawn AS (
            SELECT doc_id, {keys}, n_tokens, epochs, tail,
                md5('{MIX.seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
            FROM counted JOIN shares USING ({keys}) WHERE n_tokens > 0),
        ordered AS (
            SELECT *, sum(n_tokens) OVER (PARTITION BY {keys} ORDER BY key, n_tokens
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS start
            FROM drawn),
        used AS (
            SELECT doc_id, {keys}, n_tokens, epochs,
                CAST(greatest(0, least(n_tokens, tail - start)) AS BIGINT) AS tail_tokens
            FROM ordered)
        SELECT * FROM used WHERE epochs > 0 OR tail_tokens > 0"""


QUERIES = {
    query.__name__: query for query in (
        op1_decontaminate, op2_line_dedup, op3_language_id, op4_url_rules, op5_pii_pseudonyms,
        op6_substring_dedup, op7_secrets, op8_simhash, op9_mixing, op10_quality_rules,
        op11_prefix_trie, op12_lexical_search, op13_ngram_join)
}

ORACLES = {
    "op4_url_rules": """
        WITH marked AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.org' OR host LIKE '%.example.org')
                    AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org')
                    AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/')
                    THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/')
                    THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
                END AS rule
            FROM marked)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled""",
    # Two substitutions in twelve tokens always leave a seed intact, so the seeds do not show here.
    "op1_decontaminate": """
        WITH doc_words AS (
            SELECT doc_id, string_split(trim(regexp_replace(
                lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS w
            FROM documents),
        item_words AS (
            SELECT item_id, string_split(trim(regexp_replace(
                lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS b
            FROM benchmark),
        doc_at AS (
            SELECT doc_id, w, unnest(range(len(w))) AS p FROM doc_words),
        item_at AS (
            SELECT item_id, b, unnest(range(len(b))) AS q FROM item_words WHERE len(b) >= 12),
        -- Ten of twelve equal tokens hold a run of at least four.
        met AS (
            SELECT DISTINCT doc_id, w, item_id, b, p - q AS d
            FROM (SELECT *, w[p + 1 : p + 4] AS g FROM doc_at) x
            JOIN (SELECT *, b[q + 1 : q + 4] AS g FROM item_at WHERE q + 4 <= len(b)) y
                ON x.g = y.g),
        windows AS (
            SELECT doc_id, item_id, list_sum(list_transform(range(12), lambda k:
                CASE WHEN d + s + k >= 0 AND w[d + s + k + 1] = b[s + k + 1] THEN 1 ELSE 0 END)) AS n
            FROM (SELECT *, unnest(range(len(b) - 11)) AS s FROM met) z)
        SELECT doc_id, item_id, CAST(max(n) AS INTEGER) AS n_equal
        FROM windows WHERE n >= 10 GROUP BY doc_id, item_id""",
    "op9_mixing": _mixing_sql(),
    # Turns that differ in nothing but their place cannot be told apart, so equal ones need no order.
    "op11_prefix_trie": """
        WITH own AS (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                ORDER BY turn NULLS FIRST, role, text) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        -- CRC-32, bit by bit.
        hashed AS (
            SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
                    range(1, len(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT)),
                lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y:
                    CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)),
                4294967295::BIGINT) % 4 AS h
            FROM own),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1 : c.h], c.turns[c.h + 1 :]) AS turns
            FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
        prefixes AS (
            SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
        grouped AS (
            SELECT turns[1 : depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth) AS ends
            FROM prefixes GROUP BY ALL),
        children AS (
            SELECT path[1 : depth - 1] AS path, count(*) AS n FROM grouped WHERE depth > 0 GROUP BY ALL),
        valued AS (
            SELECT g.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1)
                * len(regexp_extract_all(g.path[depth].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
            FROM grouped g LEFT JOIN children c ON c.path = g.path),
        summed AS (
            SELECT path[1 : up] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
                sum(saved) AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS up FROM valued) x GROUP BY ALL)
        SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
            CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
            sha256(coalesce(v.ends, '')) AS ends_sha256
        FROM valued v JOIN summed s ON s.path = v.path
        LEFT JOIN valued p ON v.depth > 0 AND p.path = v.path[1 : v.depth - 1]""",
    "op12_lexical_search": """
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents),
        items AS (
            SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term
            FROM benchmark),
        totals AS (
            SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms
            FROM docs),
        counted AS (
            SELECT row, doc_id, term, count(*) AS tf, 50 + ((50 * any_value(n) * any_value(n_docs))
                // any_value(n_terms)) AS m
            FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs), totals
            GROUP BY row, doc_id, term),
        weighted AS (
            SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))
                AS BIGINT) AS w
            FROM counted, totals GROUP BY term),
        scored AS (
            SELECT item_id, row, any_value(doc_id) AS doc_id, CAST(sum(
                w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM items JOIN weighted USING (term) JOIN counted USING (term) GROUP BY item_id, row),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 50""",
    "op13_ngram_join": """
        WITH RECURSIVE docs AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_distinct(
                list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])) END AS s
            FROM docs),
        sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
        places AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
        links AS (
            SELECT a.doc_id AS u, b.doc_id AS v
            FROM places a JOIN places b ON a.g = b.g AND a.doc_id <> b.doc_id
                AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
        reached AS (
            SELECT u AS doc_id, v AS other FROM links
            UNION
            SELECT r.doc_id, l.v FROM reached r JOIN links l ON l.u = r.other)
        SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles,
            least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id
        FROM sized s LEFT JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n""",
}
