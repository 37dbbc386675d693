"""SQL for the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from telltale.llm import quality_rules as rules
from telltale.llm import url_reputation as urls

_LOW = (
    "(value >> greatest(length(bin(value)) - {d}, 0)::BIGINT)"
    " << greatest(length(bin(value)) - {d}, 0)::BIGINT"
).format(d=rules.DIGITS)


def _fence(groups: str, source: str) -> str:
    """Bounds of the metrics of a group from its sketch."""
    over = f"PARTITION BY {groups + ', ' if groups else ''}metric"
    keys = f"{groups}, " if groups else ""
    slack = " ".join(f"WHEN '{name}' THEN {s}" for name, _, _, s, _ in rules.METRICS)
    high = ", ".join(
        f"max(q3 + far) FILTER (metric = '{name}') AS {name}_high" for name, *_ in rules.METRICS
    )
    low = ", ".join(
        f"max(q1 - far) FILTER (metric = '{name}') AS {name}_low"
        for name, _, _, _, below in rules.METRICS
        if below
    )
    return f"""
      SELECT {keys}max(docs) AS docs, {high}, {low} FROM (
        SELECT *, greatest({rules.FENCE} * (q3 - q1), CASE metric {slack} END) AS far FROM (
          SELECT {keys}metric, max(docs) AS docs,
                 min(low) FILTER (4 * upto >= docs) AS q1,
                 min(low) FILTER (4 * upto >= 3 * docs) AS q3
          FROM (SELECT *, sum(n) OVER ({over} ORDER BY low) AS upto, sum(n) OVER ({over}) AS docs
                FROM (SELECT {keys}metric, low, sum(n) AS n FROM {source} GROUP BY ALL))
          GROUP BY ALL))
      {'GROUP BY ' + groups if groups else 'HAVING count(*) > 0'}"""


def quality_rules() -> str:
    words = r"[x FOR x IN string_split_regex(body, '[\x20\x09-\x0D]+') IF x <> '']"
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS metric,"
        f" CASE WHEN {b} > 0 THEN (1000 * {a}) // {b} ELSE 0 END AS value FROM facts WHERE NOT failed"
        for name, a, b, _, _ in rules.METRICS
    )
    outside = []
    for name, a, b, _, below in rules.METRICS:
        value = f"(CASE WHEN {b} > 0 THEN (1000 * {a}) // {b} ELSE 0 END)"
        sides = [(">", "high")] + [("<", "low")] * below
        for sign, side in sides:
            bound = (
                f"(CASE WHEN s.docs >= {rules.MIN_DOCS} THEN s.{name}_{side}"
                f" WHEN l.docs >= {rules.MIN_DOCS} THEN l.{name}_{side} ELSE a.{name}_{side} END)"
            )
            outside.append(f"{value} {sign} coalesce({bound}, {value})")
    return rf"""
    WITH docs AS (
      SELECT row_number() OVER () AS row_id, doc_id, coalesce(lang, '') AS lang,
             coalesce(source, '') AS source, coalesce(text, '') AS body FROM documents),
    cut AS (
      SELECT row_id, doc_id, lang, source, body, {words} AS words,
             [x FOR x IN string_split(body, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]
               AS lines FROM docs),
    places AS (
      SELECT row_id, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3, i FROM (
        SELECT row_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM cut)),
    repeated AS (
      SELECT row_id, i FROM (
        SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w1, w2, w3) AS n FROM places)
      WHERE n > 1),
    covered AS (
      SELECT row_id, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k)
      GROUP BY row_id),
    facts AS (
      SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM (
        SELECT c.row_id, doc_id, lang, source, len(words) AS n_words,
               length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
               coalesce(v.n, 0) AS n_repeat_words
        FROM cut c LEFT JOIN covered v USING (row_id))),
    sketch AS (
      SELECT lang, source, metric, {_LOW} AS low, count(*) AS n FROM ({values}) GROUP BY ALL),
    by_source AS ({_fence("lang, source", "sketch")}),
    by_lang AS ({_fence("lang", "sketch")}),
    everywhere AS ({_fence("", "sketch")})
    SELECT f.doc_id, f.lang, f.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           failed AS base_failed, NOT failed AND NOT ({" OR ".join(outside)}) AS kept
    FROM facts f LEFT JOIN by_source s ON f.lang = s.lang AND f.source = s.source
    LEFT JOIN by_lang l ON f.lang = l.lang LEFT JOIN everywhere a ON true"""


def substring_dedup(window: int = 20) -> str:
    return rf"""
    WITH docs AS (
      SELECT doc_id,
             [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
      FROM documents),
    places AS (
      SELECT doc_id, i, array_to_string(words[i:i + {window - 1}], ' ') AS run
      FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {window - 1})) AS i FROM docs)),
    later AS (
      SELECT doc_id, i
      FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS r FROM places)
      WHERE r > 1),
    gone AS (
      SELECT DISTINCT doc_id, i + k AS i
      FROM later, (SELECT unnest(generate_series(0, {window - 1})) AS k)),
    words AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
    kept AS (
      SELECT doc_id, count(g.i) AS n, string_agg(w, ' ' ORDER BY i) FILTER (g.i IS NULL) AS text
      FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (doc_id)"""


def _strength(counts: str, parent: str) -> str:
    return f"""
      SELECT round(1 / least(greatest(coalesce(
               CASE WHEN sum(room) > 0 THEN sum(extra) / sum(room) END, 0.0), 0.001), 0.5) - 1, 6)
               AS weight
      FROM (SELECT kk - gk * p - (m - 1) * p * (1 - p) AS extra,
                   (gn - gn2 / gn - (m - 1)) * p * (1 - p) AS room
            FROM (SELECT sum(n) AS gn, sum(good) AS gk, sum(n * n) AS gn2,
                         sum(good * good / n) AS kk, count(*) AS m, sum(good) / sum(n) AS p
                  FROM {counts} {'GROUP BY ' + parent if parent else 'HAVING count(*) > 0'}))"""


def url_filters(url_rules) -> str:
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN {{'rule': '{r.text}', 'verdict': '{r.verdict}'}}"
        for r in sorted(url_rules, key=lambda r: (-len(r.text), -len(r.host)))
    )
    long = ", ".join(f"'{s}'" for s in urls.LONG_SUFFIXES)
    letters = f"'{urls._UPPER}', '{urls._UPPER.lower()}'"
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
    WITH cut AS (
      SELECT page_id,
             translate(regexp_extract(coalesce(url, ''), '{pattern}', 1), {letters}) AS host,
             regexp_extract(coalesce(url, ''), '{pattern}', 2) AS path FROM pages),
    named AS (
      SELECT *, CASE WHEN last_two IN ({long}) THEN last_two ELSE names[-1] END AS suffix,
             CASE WHEN last_two IN ({long}) THEN array_to_string(names[-3:], '.') ELSE last_two END
               AS domain
      FROM (SELECT *, string_split(host, '.') AS names,
                   array_to_string(string_split(host, '.')[-2:], '.') AS last_two FROM cut)),
    hosts AS (
      SELECT suffix, domain, host, count(*)::DOUBLE AS n, sum(quality)::DOUBLE AS good
      FROM named JOIN labels ON page_id = doc_id WHERE host <> '' AND quality IN (0, 1)
      GROUP BY ALL),
    domains AS (SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY ALL),
    ws AS ({_strength("suffixes", "")}),
    wd AS ({_strength("domains", "suffix")}),
    wh AS ({_strength("hosts", "suffix, domain")}),
    at_suffix AS (
      SELECT suffix, (a.good / a.n * ws.weight + s.good) / (ws.weight + s.n) AS rate
      FROM suffixes s, ws, (SELECT sum(n) AS n, sum(good) AS good FROM suffixes) a),
    at_domain AS (
      SELECT suffix, domain, (rate * wd.weight + good) / (wd.weight + n) AS rate
      FROM domains JOIN at_suffix USING (suffix), wd),
    at_host AS (
      SELECT host, n, wh.weight AS w, (d.rate * wh.weight + h.good) / (wh.weight + h.n) AS rate
      FROM hosts h JOIN at_domain d USING (suffix, domain), wh),
    bad AS (
      SELECT host FROM at_host
      WHERE rate + {urls.Z} * sqrt(rate * (1 - rate) / (w + n + 1)) < {urls.MIN_GOOD})
    SELECT page_id, host, path, choice.rule AS rule,
           coalesce(choice.verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' END, 'allow')
             AS verdict
    FROM (SELECT *, CASE {cases} END AS choice FROM cut)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text: a byte goes in, then eight bits go out."""
    eight = ", ".join(["-1"] * 8)
    return f"""
      xor(4294967295, list_reduce(
        [4294967295::BIGINT] || flatten([[ascii(x)::BIGINT, {eight}] FOR x IN string_split({text}, '')]),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
                          WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))"""


def prefix_trie(family: int = 20, most: int = 4) -> str:
    words = r"len([x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''])"
    return f"""
    WITH spoken AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
    told AS (
      SELECT conv_id, turn, role, {words} AS words,
             sha256(strlen(role) || ':' || role || text) AS digest FROM spoken),
    turns AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS p
      FROM told),
    convs AS (
      SELECT conv_id, conv_id - conv_id % {family} AS base,
             {_crc32("conv_id::VARCHAR")} % {most} AS h
      FROM (SELECT DISTINCT conv_id FROM turns)),
    rebuilt AS (
      SELECT c.conv_id, 0 AS part, p, digest, words
      FROM convs c JOIN turns t ON t.conv_id = c.base WHERE p <= h
      UNION ALL
      SELECT c.conv_id, 1, p, digest, words FROM convs c JOIN turns t USING (conv_id) WHERE p > h),
    whole AS (
      SELECT conv_id,
             coalesce(list(digest ORDER BY part, p) FILTER (digest IS NOT NULL), []) AS digests,
             list(words ORDER BY part, p) AS words
      FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
    members AS (
      SELECT conv_id, d, array_to_string(digests[1:d], '') AS key, words[d] AS words, len(digests) AS n
      FROM (SELECT *, unnest(generate_series(0, len(digests))) AS d FROM whole)),
    nodes AS (
      SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             CASE WHEN d > 0 THEN max(words) ELSE 0 END AS words,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '') AS ends
      FROM members GROUP BY key, d),
    kids AS (
      SELECT key[:-65] AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    counted AS (SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN kids USING (key)),
    below AS (
      SELECT key[:64 * i] AS key, count(*) FILTER (kids = 0) AS n_leaves,
             sum((n_convs - 1) * words) AS saved
      FROM (SELECT *, unnest(generate_series(0, d)) AS i FROM counted) GROUP BY ALL)
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.kids AS n_children,
           n_leaves, saved::BIGINT AS saved_tokens, sha256(c.ends) AS ends_sha256
    FROM counted c JOIN below b ON b.key = c.key
    LEFT JOIN nodes p ON c.d > 0 AND p.key = c.key[:-65]"""


def merkle_manifest(arity: int = 16) -> str:
    def digest(text: str) -> str:
        fields = [f"({c})::VARCHAR" for c in ("doc_id", "source", "lang", "n_chars", text)]
        parts = " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)
        return f"sha256({parts})"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    small = f"translate(text, '{upper}', '{upper.lower()}')"
    others = f"PARTITION BY tree, level, i // {arity} ORDER BY i ROWS BETWEEN"
    above = f"""
      SELECT tree, level + 1, i // {arity}, (n + {arity - 1}) // {arity}, sha256(string_agg(h, '' ORDER BY i))
      FROM {{0}} WHERE n > 1 GROUP BY tree, level, i // {arity}, n"""
    return f"""
    WITH RECURSIVE leaves AS (
      SELECT row_number() OVER () AS row_id, doc_id, source, {digest("text")} AS leaf,
             CASE WHEN coalesce({_crc32("doc_id::VARCHAR")} % 5 = 0, false) THEN {digest(small)}
                  ELSE {digest("text")} END AS claimed
      FROM documents),
    placed AS (
      SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY source) AS n
      FROM leaves),
    low AS (
      SELECT tree, 0 AS level, i, n, leaf AS h FROM placed UNION ALL {above.format("low")}),
    subroots AS (SELECT tree, h FROM low WHERE n = 1),
    top AS (
      SELECT -1::BIGINT AS tree, 0 AS level, tree AS i, (SELECT count(*) FROM subroots) AS n, h
      FROM subroots UNION ALL {above.format("top")}),
    nodes AS (
      SELECT *, coalesce(string_agg(h, '') OVER ({others} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
             coalesce(string_agg(h, '') OVER ({others} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
      FROM (SELECT * FROM low UNION ALL SELECT * FROM top)),
    ways AS (
      SELECT p.row_id, 0 AS part, m.level, before, after
      FROM placed p JOIN nodes m ON m.tree = p.tree AND m.i = p.i // ({arity} ** m.level)::BIGINT
      WHERE m.n > 1
      UNION ALL
      SELECT p.row_id, 1, m.level, before, after
      FROM placed p JOIN nodes m ON m.tree = -1 AND m.i = p.tree // ({arity} ** m.level)::BIGINT
      WHERE m.n > 1),
    steps AS (
      SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY part, level) AS step FROM ways),
    proofs AS (
      SELECT row_id, max(step) AS n, sha256(string_agg(before || after, '' ORDER BY step)) AS proof
      FROM steps GROUP BY row_id),
    fold AS (
      SELECT row_id, 0::BIGINT AS step, claimed AS h FROM placed
      UNION ALL
      SELECT f.row_id, s.step, sha256(s.before || f.h || s.after)
      FROM fold f JOIN steps s ON s.row_id = f.row_id AND s.step = f.step + 1),
    root AS (SELECT h FROM top WHERE n = 1)
    SELECT doc_id, leaf, b.h AS subroot, r.h AS root, coalesce(proof, sha256('')) AS proof_sha256,
           f.h AS folded_root, f.h = r.h AS verified
    FROM placed p JOIN subroots b USING (tree) JOIN root r ON true
    LEFT JOIN proofs q ON q.row_id = p.row_id
    JOIN fold f ON f.row_id = p.row_id AND f.step = coalesce(q.n, 0)"""


def statements() -> dict[str, str]:
    from telltale.llm.queries import URL_RULES

    return {
        "op6_substring_dedup": substring_dedup(),
        "op7_quality_rules": quality_rules(),
        "op9_url_filters": url_filters(URL_RULES),
        "op11_prefix_trie": prefix_trie(),
        "op12_merkle_manifest": merkle_manifest(),
    }
