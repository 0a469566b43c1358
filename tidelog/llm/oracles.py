"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from tidelog.llm.decontaminate import WINDOW
from tidelog.llm.manifest import FAN, FIELDS
from tidelog.llm.near_dedup import PERCENT, SHINGLE
from tidelog.llm.rules import REPEAT_WINDOW, RULES, mask

_SPACE = r"\x20\x09-\x0D"


def _grams(length: int, part: str) -> str:
    """So many consecutive words from word ``i`` on; NULL at the end of a text."""
    ahead = [f"lead(word, {k}) OVER (PARTITION BY {part} ORDER BY i)" for k in range(1, length)]
    return " || ' ' || ".join(["word", *ahead])


def decontamination() -> str:
    words = (
        f"regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    lengths = range(1, WINDOW + 1)
    return f"""WITH item_lists AS (SELECT item_id, {words} AS ws FROM benchmark WHERE text IS NOT NULL),
    item_words AS (SELECT item_id, least(len(ws), {WINDOW}) AS size,
      unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM item_lists),
    item_grams AS (SELECT item_id, size, {", ".join(f"{_grams(n, 'item_id')} AS g{n}" for n in lengths)} FROM item_words),
    windows AS ({" UNION ALL ".join(f"SELECT item_id, size, g{n} AS gram FROM item_grams WHERE size = {n} AND g{n} IS NOT NULL" for n in lengths)}),
    doc_lists AS (SELECT doc_id, {words} AS ws FROM documents WHERE text IS NOT NULL),
    doc_words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM doc_lists),
    doc_grams AS (SELECT doc_id, i, {", ".join(f"{_grams(n, 'doc_id')} AS g{n}" for n in lengths)} FROM doc_words),
    found AS ({" UNION ALL ".join(f"SELECT doc_id, i, size, item_id FROM doc_grams JOIN windows ON size = {n} AND g{n} = gram" for n in lengths)}),
    hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
      FROM found, (SELECT unnest(range(0, {WINDOW})) AS k) AS steps WHERE k < size GROUP BY doc_id),
    named AS (SELECT doc_id, CAST(item_id AS VARCHAR) AS name FROM found GROUP BY 1, 2),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM named GROUP BY doc_id),
    counted AS (SELECT d.doc_id, coalesce(len(ws), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
      coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256
      FROM documents d LEFT JOIN doc_lists l ON d.doc_id = l.doc_id
      LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items t ON d.doc_id = t.doc_id)
    SELECT doc_id, n_words, n_hit, n_items, items_sha256,
      n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM counted"""


def rule_ledger(policy: str) -> str:
    bits = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << bit} ELSE 0 END" for bit, rule in enumerate(RULES))
    length = lambda kept: f"length(regexp_replace(text, '{kept}', '', 'g'))"
    return rf"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    lists AS (SELECT doc_id, text, regexp_extract_all(text, '[^{_SPACE}]+') AS ws FROM texts),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM lists),
    grams AS (SELECT doc_id, i, {_grams(REPEAT_WINDOW, 'doc_id')} AS gram FROM words),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n
      FROM grams WHERE gram IS NOT NULL) AS counted WHERE n > 1),
    repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n
      FROM twice, (SELECT unnest(range(0, {REPEAT_WINDOW})) AS k) AS steps GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) AS split
      WHERE regexp_matches(line, '[^{_SPACE}]') GROUP BY doc_id),
    measured AS (SELECT t.doc_id, len(ws) AS n_words, {length(f'[{_SPACE}]')} AS word_chars,
      length(text) - {length('[#*$%&|<>]')} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
      coalesce(r.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
      {length(r'[\x00-\x40\x5B-\x60\x7B-\x7F]')} AS n_letters, {length('[^A-Z]')} AS n_capitals
      FROM lists t LEFT JOIN lines l ON t.doc_id = l.doc_id LEFT JOIN repeats r ON t.doc_id = r.doc_id),
    judged AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM measured)
    SELECT *, (fail_bits & {mask('base')}) <> 0 AS base_failed,
      (fail_bits & {mask('base') | mask(policy)}) = 0 AS kept FROM judged"""


def near_duplicates() -> str:
    words = f"regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '[^{_SPACE}]+')"
    return f"""WITH RECURSIVE lists AS (SELECT doc_id, {words} AS ws FROM documents WHERE text IS NOT NULL),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM lists),
    grams AS (SELECT doc_id, {_grams(SHINGLE, 'doc_id')} AS shingle FROM words),
    sets AS (SELECT DISTINCT doc_id, shingle FROM grams WHERE shingle IS NOT NULL
      UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM lists WHERE len(ws) BETWEEN 1 AND {SHINGLE - 1}),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS shared
      FROM sets a JOIN sets b ON a.shingle = b.shingle WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT one, other FROM pairs JOIN sizes s ON one = s.doc_id JOIN sizes t ON other = t.doc_id
      WHERE 100 * shared >= {PERCENT} * (s.n + t.n - shared)),
    reached AS (SELECT one, other FROM links
      UNION SELECT r.one, l.other FROM reached r JOIN links l ON r.other = l.one),
    least AS (SELECT one, min(other) AS other FROM reached GROUP BY one)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
      d.doc_id <= coalesce(other, d.doc_id) AS kept
    FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN least ON d.doc_id = one"""


def _crc(text: str) -> str:
    """crc32 of ASCII text: a byte is joined, then eight bits are shifted out."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: list_prepend(CAST(ord(c) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1])))"
    shifted = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE {shifted} END), 4294967295)"


def _tree(name: str, key: str, levels: int) -> str:
    """Levels 1 and up over ``{name}0`` (key, i, total, h), and the siblings at each level."""
    run = f"OVER (PARTITION BY {key}, i // {FAN} ORDER BY i ROWS BETWEEN"
    parts = []
    for k in range(levels):
        parts += [
            f"""{name}s{k} AS (SELECT {key}, i, total, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
      coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind FROM {name}{k})""",
            f"""{name}{k + 1} AS (SELECT {key}, i // {FAN} AS i, (any_value(total) + {FAN - 1}) // {FAN} AS total,
      CASE WHEN any_value(total) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY {key}, i // {FAN})""",
        ]
    return ",\n    ".join(parts)


def manifest(levels: int = 8, top_levels: int = 4) -> str:
    """Right for up to 8^``levels`` rows of a language and 8^``top_levels`` languages."""
    field = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    low = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    leaf = " || ".join(field(name) for name in FIELDS)
    changed = " || ".join(field(low if name == "text" else name) for name in FIELDS)
    folds = []
    for n in range(levels + top_levels):
        tree, k, place, on = ("n", n, "pos", "f.lang IS NOT DISTINCT FROM s.lang AND ") if n < levels else ("t", n - levels, "grp", "")
        folds.append(
            f"""f{n + 1} AS (SELECT f.* EXCLUDE (h, proof), CASE WHEN s.total = 1 THEN h ELSE sha256(before || h || behind) END AS h,
      proof || before || behind AS proof FROM f{n} f JOIN {tree}s{k} s ON {on}s.i = f.{place} // {FAN**k})"""
        )
    return f"""WITH leaves AS (SELECT doc_id, lang, sha256({leaf}) AS leaf,
      CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({changed}) END AS now FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
      count(*) OVER (PARTITION BY lang) AS total, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp FROM leaves),
    n0 AS (SELECT lang, pos AS i, total, leaf AS h FROM placed),
    {_tree("n", "lang", levels)},
    t0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS total, h FROM n{levels}),
    {_tree("t", "one", top_levels)},
    f0 AS (SELECT p.doc_id, p.lang, p.pos, p.grp, p.leaf, t0.h AS subroot, coalesce(p.now, p.leaf) AS h, '' AS proof
      FROM placed p JOIN t0 ON t0.i = p.grp),
    {", ".join(folds)}
    SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
    FROM f{levels + top_levels} f, t{top_levels} t"""
