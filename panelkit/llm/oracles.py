"""SQL for the queries of this package, for an engine with RE2 regular expressions."""

from __future__ import annotations

import math

from panelkit.llm.license_scan import BREAKS, CONTAINMENT, PHRASES, TEMPLATES

SPACE = r"[\x20\x09-\x0D]+"

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _licenses() -> str:
    phrases = ", ".join(f"({phrase.split()}, '{label}')" for phrase, label in PHRASES)
    templates = ", ".join(
        f"({(words := sorted(set(text.split())))}, '{label}', {math.ceil(CONTAINMENT * len(words) - 1e-9)})"
        for text, label in TEMPLATES
    )
    return rf"""
        WITH phrases(parts, label) AS (VALUES {phrases}),
        templates(parts, label, need) AS (VALUES {templates}),
        d AS (
            SELECT doc_id, {LOWER} AS text,
                   list_filter(regexp_split_to_array({LOWER}, '{BREAKS}'), lambda x: x != '') AS w
            FROM documents
        ),
        places AS (
            SELECT doc_id, label, i FROM d, phrases, unnest(range(len(w))) AS u(i)
            WHERE list_contains(w, parts[-1]) AND w[i + 1 : i + len(parts)] = parts
        ),
        base AS (
            SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                   list_sort(list_distinct(list(label))) AS base
            FROM places GROUP BY doc_id
        ),
        lines AS (
            SELECT doc_id, regexp_split_to_array(line, '{BREAKS}') AS words
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
        ),
        hits AS (
            SELECT doc_id, label, len(list_intersect(words, parts)) / len(parts) AS share
            FROM lines, templates WHERE len(list_intersect(words, parts)) >= need
        ),
        more AS (
            SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share FROM hits GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(array_to_string(base, ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(base, more))), ','), '')
                   AS labels,
               CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
    """


def _crc32_table() -> list[int]:
    table = list(range(256))
    for _ in range(8):
        table = [(value >> 1) ^ 0xEDB88320 if value & 1 else value >> 1 for value in table]
    return table


#: CTE with the table of CRC-32.
CRC = f"crc AS (SELECT {_crc32_table()}::BIGINT[] AS steps)"


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text; ``steps`` of the CTE must be in reach."""
    digits = f"list_transform(range(0, len(hex({text})), 2), lambda i: ('0x' || substr(hex({text}), i + 1, 2))::BIGINT)"
    folded = (
        f"list_reduce({digits}, lambda sum, byte: xor(sum >> 8, steps[1 + (xor(sum, byte) & 255)]), 4294967295::BIGINT)"
    )
    return f"xor(CASE WHEN {text} = '' THEN 4294967295 ELSE {folded} END, 4294967295)"


def _resampling() -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    runs = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
        WITH RECURSIVE {CRC},
        d AS (SELECT doc_id, {words} AS w FROM documents),
        b AS (SELECT {words} AS w FROM benchmark),
        fd AS (SELECT doc_id, unnest({runs}) AS f FROM d),
        fb AS (SELECT unnest({runs}) AS f FROM b),
        distinct_features AS MATERIALIZED (SELECT f FROM fd UNION SELECT f FROM fb),
        bucket AS MATERIALIZED (SELECT f, {_crc32("f")} % 10000 AS b FROM distinct_features, crc),
        s AS (SELECT b, count(*) AS s FROM fd JOIN bucket USING (f) GROUP BY b),
        t AS (SELECT b, count(*) AS t FROM fb JOIN bucket USING (f) GROUP BY b),
        gain AS (
            SELECT b, floor(1000 * ln(
                ((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000))::DOUBLE
                / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))::DOUBLE))::BIGINT AS gain
            FROM s FULL JOIN t USING (b)
        ),
        weights AS (
            SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM fd JOIN bucket USING (f) JOIN gain USING (b) GROUP BY doc_id
        ),
        scored AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM d LEFT JOIN weights USING (doc_id)
        ),
        placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_words >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed USING (doc_id)
    """


def _conversations() -> str:
    """The cheapest edits by dynamic programming over the four states of the role grammar."""

    def better(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def added(state: str, cost: str, letter: str, condition: str = "TRUE") -> str:
        return f"CASE WHEN {state} IS NOT NULL AND {condition} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}} END"

    stays = "NOT gone"
    # 0: nothing yet, 1: after system, 2: after user, 3: after assistant
    row0 = added("s0", "2", "D")
    row1 = better(added("s1", "2", "D"), added("s0", "more", "K", f"{stays} AND initial = 's'"))
    into = [f"s{i}" for i in (0, 1, 3)]
    row2 = better(
        added("s2", "2", "D"),
        *(added(s, "more", "K", f"{stays} AND initial = 'u'") for s in into),
        *(added(s, "more + 1", "R", stays) for s in into),
    )
    row3 = better(
        added("s3", "2", "D"),
        added("s2", "more", "K", f"{stays} AND initial = 'a'"),
        added("s2", "more + 1", "R", stays),
    )
    twice = [f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + 10, 'a': {s}.a || 'II'}} END" for s in ("s0", "s1")]
    open2 = better("s2", *(added(s, "5", "I") for s in into))
    open3 = better("s3", added("s2", "5", "I"), *twice)
    start = "{'c': 0::BIGINT, 'a': ''}"
    return rf"""
        WITH RECURSIVE {CRC},
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations
        ),
        faulty AS MATERIALIZED (SELECT conv_id, turn, role, text, {_crc32("key")} % 20 AS fault FROM keyed, crc),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
            FROM faulty WHERE fault != 0
        ),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   left(role, 1) AS initial, regexp_replace(text, '[ 	-
]+$', '') AS body
            FROM damaged
        ),
        judged AS MATERIALIZED (
            SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous,
                   CASE WHEN body = '' THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
            FROM numbered
        ),
        counts AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal,
                   list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts
            FROM judged GROUP BY conv_id
        ),
        -- states after row i, first as the row leaves them, then with insertions
        raw(conv_id, i, s0, s1, s2, s3) AS (
            SELECT conv_id, 0::BIGINT, {start}, NULL::STRUCT(c BIGINT, a VARCHAR), NULL::STRUCT(c BIGINT, a VARCHAR),
                   NULL::STRUCT(c BIGINT, a VARCHAR)
            FROM counts
            UNION ALL
            SELECT o.conv_id, j.i, {row0}, {row1}, {row2}, {row3}
            FROM (SELECT conv_id, i, s0, s1, {open2} AS s2, {open3} AS s3 FROM raw) o
            JOIN (
                SELECT conv_id, i, initial, coalesce(fault IN ('blank', 'duplicate'), FALSE) AS gone,
                       CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
                FROM judged
            ) j ON o.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = o.i + 1
        ),
        best AS (
            SELECT r.conv_id, {better("s0", open3)} AS best FROM raw r JOIN counts k
            ON r.conv_id IS NOT DISTINCT FROM k.conv_id AND r.i = k.n
        ),
        edits AS (
            SELECT b.conv_id, best.c AS cost, best.a AS audit, string_split(best.a, '') AS letters, k.*  EXCLUDE (conv_id)
            FROM best b JOIN counts k ON b.conv_id IS NOT DISTINCT FROM k.conv_id
        ),
        remaining AS (
            SELECT *, list_transform(
                       list_filter(range(1, len(audit) + 1), lambda p: letters[p] != 'D'),
                       lambda p: {{'letter': letters[p], 'row': len(replace(left(audit, p), 'I', ''))}}) AS rest
            FROM edits
        ),
        opened AS (
            SELECT *, CASE WHEN rest[1].letter = 'K' AND left(roles[rest[1].row], 1) = 's' THEN 1 ELSE 0 END AS system
            FROM remaining
        ),
        repaired AS (
            SELECT *, array_to_string(list_transform(rest, lambda x, p:
                CASE WHEN x.letter = 'K' THEN roles[x.row] WHEN (p - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || CASE WHEN x.letter = 'I' THEN '' ELSE texts[x.row] END), chr(10)) AS lines
            FROM opened
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
    """


def _near_duplicates() -> str:
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(4))
    return rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '{SPACE}'), lambda x: x != '') AS w
            FROM documents
        ),
        sets AS (
            SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: {shingle})) END) AS s
            FROM d
        ),
        named AS (
            SELECT doc_id, len(s) AS n, CASE WHEN len(s) = 0 THEN doc_id
                ELSE min(doc_id) OVER (PARTITION BY array_to_string(s, chr(10))) END AS rep, s
            FROM sets
        ),
        tokens AS (SELECT doc_id, n, unnest(s) AS t FROM named WHERE doc_id = rep),
        links AS MATERIALIZED (
            SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id != b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ),
        reached(root, x) AS (
            SELECT DISTINCT rep, rep FROM named
            UNION
            SELECT root, y FROM reached JOIN links USING (x)
        ),
        lowest AS (SELECT root AS rep, min(x) AS component_id FROM reached GROUP BY root)
        SELECT doc_id, n AS n_shingles, component_id FROM named JOIN lowest USING (rep)
    """


def _repeats() -> str:
    """Repeated strings by their digests; a byte has two hexadecimal digits."""
    return """
        WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h FROM documents),
        -- pieces with 500 starts each, so that cutting out a string does not walk a long text
        pieces AS (
            SELECT doc_id, 500 * c AS base, substr(h, 1000 * c + 1, 1198) AS piece
            FROM (SELECT doc_id, h, unnest(range(0, (len(h) // 2 + 400) // 500)) AS c FROM d WHERE len(h) >= 200)
        ),
        starts AS (SELECT doc_id, base, piece, unnest(range(0, len(piece) // 2 - 99)) AS i FROM pieces),
        strings AS (SELECT doc_id, base + i AS i, md5_number(substr(piece, 2 * i + 1, 200)) AS digest FROM starts),
        again AS (
            SELECT doc_id, i FROM strings
            QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id, i) > 1
        ),
        opened AS (
            SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS opens
            FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ),
        numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM opened),
        runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
        placed AS (
            SELECT r.*, h, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS since
            FROM runs r JOIN d ON r.doc_id = d.doc_id
        ),
        cut AS (
            SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                   string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
            FROM placed GROUP BY doc_id
        )
        SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
    """


ORACLES = {
    "op2_ngram_jaccard": _near_duplicates(),
    "op4_suffix_dedup": _repeats(),
    "op5_exact_dedup": rf"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') AS text
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(text) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY text)
    """,
    "op10_license_scan": _licenses(),
    "op11_conversation_repair": _conversations(),
    "op13_target_resampling": _resampling(),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
