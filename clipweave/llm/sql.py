"""SQL that says what some pN_ queries must give, written from the statements of the problems and not from the operators."""

from __future__ import annotations

import unicodedata

P4 = """
WITH v AS (SELECT id, CAST(any_value(speaker_embedding) AS DOUBLE[192]) AS e FROM chunks
  WHERE id IS NOT NULL AND speaker_embedding IS NOT NULL AND len(speaker_embedding) = 192 AND list_bool_and([NOT isnan(x) FOR x IN speaker_embedding])
    AND list_sum([abs(x) FOR x IN speaker_embedding]) > 0 GROUP BY id)
SELECT a.id AS id_a, b.id AS id_b FROM v a JOIN v b ON a.id < b.id WHERE array_cosine_similarity(a.e, b.e) >= 0.95
"""

_SPEAKER = r"nullif(upper(regexp_replace(speaker_id, '^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$', '', 'g')), '')"
_HOPS = 8  # steps in which the least id of a group spreads over its links; groups of one voice are a step or two across

# Groups are what links of cosine 0.65 connect: every chunk takes the least number among its neighbours, again and again.
P2 = f"""
WITH v AS (SELECT id, any_value({_SPEAKER}) AS speaker_id, CAST(any_value(speaker_embedding) AS DOUBLE[192]) AS e FROM chunks
  WHERE id IS NOT NULL AND speaker_embedding IS NOT NULL AND len(speaker_embedding) = 192 AND list_bool_and([NOT isnan(x) FOR x IN speaker_embedding])
    AND list_sum([abs(x) FOR x IN speaker_embedding]) > 0 GROUP BY id),
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON array_cosine_similarity(a.e, b.e) >= 0.65),
g0 AS (SELECT id, id AS g FROM v),
{", ".join(f"g{n + 1} AS MATERIALIZED (SELECT e.a AS id, min(g) AS g FROM e JOIN g{n} ON g{n}.id = e.b GROUP BY e.a)" for n in range(_HOPS))},
m AS (SELECT id, speaker_id, g FROM v JOIN g{_HOPS} USING (id)),
n AS (SELECT g, speaker_id AS name, count(*) AS k FROM m WHERE speaker_id IS NOT NULL GROUP BY 1, 2),
w AS (SELECT g, name FROM n JOIN (SELECT g, sum(k) AS labelled FROM n GROUP BY g) USING (g) WHERE k * 2 > labelled)
SELECT id, name AS speaker_id FROM m JOIN w USING (g) WHERE speaker_id IS NULL OR speaker_id <> name
"""

# What the assignment must be: every share within a point, for all chunks and for those of each gender, no speaker torn apart.
P7_CHECKS = """
WITH c AS (SELECT CASE left(lower(trim(any_value(gender))), 1) WHEN 'm' THEN 'male' WHEN 'f' THEN 'female' ELSE 'unknown' END AS gender FROM chunks WHERE id IS NOT NULL GROUP BY id)
SELECT people, true AS train, true AS validation, true AS test, CAST(0 AS BIGINT) AS torn FROM (SELECT DISTINCT gender AS people FROM c UNION ALL SELECT 'all')
"""

# What the packing must be: every document with a text laid down once and whole, and no rule broken.
P8_CHECKS = """
SELECT count(*) AS documents, CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS cut_in_vain, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS overlapping
FROM (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING max(text) <> '')
"""

_SCORES = {"dnsmos_bak": (1, 5), "dnsmos_sig": (1, 5), "utmos": (1, 5), "window_similarity": (-1, 1)}
_WALK_ROUNDS, _WALK_ON = 12, 0.15


def _walk(n: int) -> str:
    """One more step of the walk by which the four scores are ranked together, from round n - 1 to n."""
    came = " + ".join(
        f"coalesce(sum(CASE WHEN a{i} > 0 THEN p / a{i} END) OVER (ORDER BY {c} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0)" for i, c in enumerate(_SCORES)
    )
    lost = " + ".join(f"CASE WHEN a{i} = 0 THEN p ELSE 0 END" for i in range(len(_SCORES)))
    kept = ", ".join(["id", "n", *_SCORES, *[f"a{i}" for i in range(len(_SCORES))]])
    return f"w{n} AS (SELECT {kept}, {1 - _WALK_ON}::DOUBLE / n + {_WALK_ON}::DOUBLE * (({came}) / {len(_SCORES)} + (sum({lost}) OVER ()) / {len(_SCORES)} / n) AS p FROM w{n - 1})"


# The chain itself, step by step over whole windows: climb uniformly among the items above in one of four scores.
P5 = f"""
WITH one AS (SELECT id, {", ".join(f"any_value({c}) AS {c}" for c in _SCORES)} FROM chunks WHERE id IS NOT NULL GROUP BY id),
u AS (SELECT * FROM one WHERE {" AND ".join(f"NOT isnan({c}) AND {c} BETWEEN {a} AND {b}" for c, (a, b) in _SCORES.items())}),
w0 AS (SELECT *, count(*) OVER () AS n, {", ".join(f"count(*) OVER () - count(*) OVER (ORDER BY {c} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a{i}" for i, c in enumerate(_SCORES))},
  1.0::DOUBLE / count(*) OVER () AS p FROM u),
{", ".join(_walk(n + 1) for n in range(_WALK_ROUNDS))},
o AS (SELECT id, n, row_number() OVER (ORDER BY round(p * n, 9) DESC, id) AS place FROM w{_WALK_ROUNDS})
SELECT id FROM o WHERE place <= n // 100
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Letters that look like others, and the others, one below the other.
_ALIKE = "аеорсухіјѕһԁԛԝѵАВЕКМНОРСТХІЈЅԌԜονΑΒΕΖΗΙΚΜΝΟΡΤΥΧոսցکیەɡɑ"
_PLAIN = "aeopcyxijshdqwvABEKMHOPCTXIJSGWovABEZHIKMNOPTYXnugكيهga"
# The presentation forms of Arabic letters and their ligatures, and the forms of full width.
_JOINED = [c for c in range(0xFE80, 0xFEFD)]
_WIDE = [c for c in range(0xFF01, 0xFF5F)]


def _shown(column: str) -> str:
    """The text as it shows, by plain replacements: characters without a glyph go, look-alikes and widths become one."""
    out = rf"regexp_replace({column}, '[\p{{Cf}}\x{{0}}-\x{{8}}\x{{E}}-\x{{1B}}\x{{7F}}-\x{{84}}\x{{86}}-\x{{9F}}\x{{FE00}}-\x{{FE0F}}\x{{34F}}]', '', 'g')"
    plain = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in _JOINED} | {chr(c): chr(c - 0xFEE0) for c in _WIDE}
    for a, b in plain.items():
        if len(b) > 1:
            out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    single = {a: b for a, b in plain.items() if len(b) == 1} | dict(zip(_ALIKE, _PLAIN))
    out = f"nfc_normalize(translate({out}, {_quoted(''.join(single))}, {_quoted(''.join(single.values()))}))"
    return rf"regexp_replace(trim(regexp_replace({out}, '[\p{{Zs}}\t\x{{B}}\x{{C}}]+', ' ', 'g')), '^\s+|\s+$', '', 'g')"


P6 = f"""
WITH t AS (SELECT DISTINCT id, 'text' AS field, text AS raw FROM transcripts WHERE text <> '' UNION SELECT DISTINCT id, 'tagged', text_tagged FROM transcripts WHERE text_tagged <> ''),
s AS (SELECT id, field, raw, {_shown("raw")} AS shown FROM t WHERE id IS NOT NULL)
SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM s a JOIN s b USING (field, shown) WHERE a.id < b.id AND a.raw <> b.raw AND shown <> ''
"""

# Vowel marks above and below Arabic letters, and the stretching stroke.
_MARKS = r"\x{610}-\x{61A}\x{64B}-\x{652}\x{656}-\x{65F}\x{670}\x{6D6}-\x{6DC}\x{6DF}-\x{6E4}\x{6E7}\x{6E8}\x{6EA}-\x{6ED}\x{640}"


def _words(column: str) -> str:
    bare = rf"regexp_replace({column}, '\[\s*/?\s*[A-Za-z_ -]{{1,40}}?\s*\]', ' ', 'g')"
    bare = rf"regexp_replace(lower({bare}), '[{_MARKS}\p{{Cf}}]', '', 'g')"
    return rf"[w FOR w IN regexp_split_to_array({bare}, '[^\p{{L}}\p{{N}}\p{{M}}]+') IF w <> '']"


P9 = f"""
WITH d AS (SELECT doc_id, {_words("any_value(text)")} AS w FROM documents WHERE text IS NOT NULL GROUP BY doc_id),
i AS (SELECT item_id, {_words("any_value(text)")} AS w FROM eval_items WHERE text IS NOT NULL GROUP BY item_id),
n AS (SELECT item_id, w, least(len(w), 12) AS k FROM i WHERE len(w) > 0),
p AS (SELECT item_id, k, unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS passage FROM n),
g AS (SELECT doc_id, k, unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS passage FROM d, (SELECT DISTINCT k FROM n) WHERE len(w) >= k)
SELECT DISTINCT doc_id, item_id FROM g JOIN p USING (k, passage)
"""
