"""The SQL that the queries must equal, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from tideline.llm import sharding
from tideline.llm.mixing import HEX, MAX_REPEATS, ROUNDS


def _mix_sql() -> str:
    """Certain copies, then the rounds of the order sample, each as one window."""
    rounds = []
    for k in range(1, ROUNDS + 1):
        before = "start" if k == 1 else f"round{k - 1}"
        rounds.append(
            f"""open{k} AS (
                SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank) AS through
                FROM {before} WHERE rank > after AND size <= gap AND NOT taken
            ), limit{k} AS (
                SELECT source, min(rank) FILTER (through > gap) AS block,
                       coalesce(max(through) FILTER (through <= gap), 0) AS words
                FROM open{k} GROUP BY source
            ), round{k} AS (
                SELECT b.doc_id, b.source, b.size, b.source_size, b.target, b.certain, b.rank,
                       b.taken OR (b.rank > b.after AND b.size <= b.gap
                                   AND b.rank < coalesce(l.block, 2)) AS taken,
                       b.gap - coalesce(l.words, 0) AS gap, coalesce(l.block, 2) AS after
                FROM {before} b LEFT JOIN limit{k} l ON b.source IS NOT DISTINCT FROM l.source
            )"""
        )
    return f"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '-') || ':'
                       || md5(coalesce(text, ''))), 1, {HEX}))::BIGINT::DOUBLE + 0.5)
                       / {16**HEX}::DOUBLE AS u
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, sum(size)::BIGINT * {MAX_REPEATS} AS cap,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM sized GROUP BY source
        ), shares AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
                          ORDER BY cap / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                      / (sum(weight) OVER (
                          ORDER BY cap / weight, source NULLS LAST
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share
            FROM sources
        ), targets AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, weight * (SELECT max(share) FROM shares)) AS target
            FROM shares
        ), wanted AS (
            SELECT doc_id, d.source, size, u, source_size, target,
                   CASE WHEN source_size > 0
                        THEN least({MAX_REPEATS}.0::DOUBLE, target / source_size) ELSE 0 END AS e
            FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
        ), ranked AS (
            SELECT *, floor(e)::BIGINT AS certain, CASE WHEN e > floor(e) THEN
                u * (1 - (e - floor(e))) / (u * (1 - (e - floor(e))) + (1 - u) * (e - floor(e)))
                END AS rank
            FROM wanted
        ), start AS (
            SELECT doc_id, source, size, source_size, target, certain, rank, false AS taken,
                   floor(target - sum(certain * size) OVER (PARTITION BY source))::BIGINT AS gap,
                   -1.0::DOUBLE AS after
            FROM ranked
        ), {", ".join(rounds)}
        SELECT doc_id, size, source_size, target,
               (certain + CASE WHEN taken THEN 1 ELSE 0 END) * size AS taken
        FROM round{ROUNDS}
    """


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a string's bytes, byte by byte over the table of the polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
        table.append(byte)
    return f"""xor(list_reduce(
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT),
        lambda c, b: xor(c >> 8, ({table}::BIGINT[])[xor(c, b) % 256 + 1]),
        4294967295::BIGINT), 4294967295::BIGINT)"""


def _shards_sql() -> str:
    """Row numbers, then the rounds as nested queries, again while a number is not below n."""
    turned = "SELECT number, n, a, b, step, pos // b AS l, pos % b AS r FROM walk WHERE step = 0 OR pos >= n"
    for k in range(1, sharding.ROUNDS + 1):
        moved, by, side = ("l", "r", "a") if k % 2 else ("r", "l", "b")
        kept = "r" if moved == "l" else "l"
        turned = f"""SELECT number, n, a, b, step, {kept}, ({moved} + ('0x' || substr(md5(
            '{sharding.SEED}:{k}:' || {by}), 1, {sharding.HEX}))::BIGINT % {side}) % {side} AS {moved}
            FROM ({turned})"""
    return f"""
        WITH RECURSIVE rows AS (
            SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
                   {_crc32("coalesce(text, '')")} AS text_crc32,
                   row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(text, ''))) - 1
                       AS number,
                   count(*) OVER () AS n
            FROM documents
        ), grid AS (
            SELECT number, n, greatest(1, ceil(sqrt(n)))::BIGINT AS a FROM rows
        ), walk AS (
            SELECT number, n, a, (n + a - 1) // a AS b, 0 AS step, number AS pos FROM grid
            UNION ALL
            SELECT number, n, a, b, step + 1, l * b + r FROM ({turned})
        )
        SELECT doc_id, size, text_crc32, 'rows' AS law, (pos % {sharding.SHARDS})::INTEGER AS shard,
               pos // {sharding.SHARDS} AS slot, NULL::INTEGER AS grown_shard
        FROM rows JOIN walk USING (number) WHERE step > 0 AND pos < rows.n
    """


def _edited(path: str, cost: int | str, letter: str) -> str:
    """A path, twelve digits of cost and the audit, with one edit more."""
    return f"""(lpad((substr({path}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0')
        || substr({path}, 13) || '{letter}')"""


def _repair_sql() -> str:
    """Forward over the rows of each conversation, the least path to each of four states by row."""
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    stays = "fault NOT IN ('blank', 'duplicate')"

    def read(to: str, before: tuple[str, ...], initial: str | None) -> str:
        ways = [_edited(to, 4, "D")]
        for f in before:
            if to in ("f2", "f3"):
                ways.append(f"CASE WHEN {stays} THEN {_edited(f, f'(3 + {extra})', 'R')} END")
            if initial:
                ways.append(
                    f"CASE WHEN {stays} AND initial = '{initial}' THEN {_edited(f, f'({extra})', 'K')} END"
                )
        return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]

    return f"""
        WITH RECURSIVE kinds AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}
                       % 20 AS kind
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                        ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds
        ), placed AS (
            SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i
            FROM damaged
        ), judged AS (
            SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS former,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated'
                        ELSE '' END AS fault
            FROM placed
        ), counts AS (
            SELECT conv_id, count(*) AS n,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (former || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ), paths AS (
            SELECT conv_id, n, 0::BIGINT AS i, repeat('0', 12) AS f0, NULL::VARCHAR AS f1,
                   repeat('0', 11) || '3I' AS f2, repeat('0', 11) || '6II' AS f3
            FROM counts
            UNION ALL
            SELECT conv_id, n, i, f0, f1, f2, least(f3, {_edited("f2", 3, "I")}) FROM (
                SELECT conv_id, n, i, f0, f1, f3, least(f2, {_edited("f0", 3, "I")},
                       {_edited("f1", 3, "I")}, {_edited("f3", 3, "I")}) AS f2
                FROM (
                    SELECT p.conv_id, n, j.i, {read("f0", (), None)} AS f0,
                           {read("f1", ("f0",), "s")} AS f1,
                           {read("f2", ("f0", "f1", "f3"), "u")} AS f2,
                           {read("f3", ("f2",), "a")} AS f3
                    FROM paths p JOIN judged j
                        ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = p.i + 1
                )
            )
        ), best AS (
            SELECT conv_id, substr(least(f0, f3), 1, 12)::BIGINT AS cost,
                   substr(least(f0, f3), 13) AS audit
            FROM paths WHERE i = n
        ), letters AS (
            SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM best
        ), edits AS (
            SELECT conv_id, pos, audit[pos] AS letter,
                   length(replace(audit[1:pos], 'I', '')) AS i,
                   length(replace(audit[1:pos - 1], 'D', '')) AS emitted
            FROM letters
        ), found AS (
            SELECT e.conv_id, pos, letter, emitted, j.text, j.role,
                   max(emitted = 0 AND letter = 'K' AND initial = 's')
                       OVER (PARTITION BY e.conv_id)::BIGINT AS has_system
            FROM edits e LEFT JOIN judged j
                ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.i = j.i AND letter <> 'I'
        ), repaired AS (
            SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role
                       WHEN (emitted - has_system) % 2 = 0 THEN 'user' ELSE 'assistant' END
                       || ':' || coalesce(text, ''), chr(10) ORDER BY pos) AS lines
            FROM found WHERE letter <> 'D' GROUP BY conv_id
        )
        SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) k
        LEFT JOIN counts c ON k.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN best b ON k.conv_id IS NOT DISTINCT FROM b.conv_id
        LEFT JOIN repaired r ON k.conv_id IS NOT DISTINCT FROM r.conv_id
    """


def _spelling_sql() -> str:
    """Near words by what is left of them without one code point, at the same place or as a word."""
    return f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, lower_run AS run, count(*) AS n FROM (
                SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_run
                FROM documents) GROUP BY ALL
        ), hashed AS (
            SELECT run, n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
            FROM runs WHERE length(run) >= 5
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run))
                    || substr(run, h % length(run) + 2) ELSE run END AS word
                FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), without AS (
            SELECT word, n, pos, substr(word, 1, pos) || substr(word, pos + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS pos FROM words)
        ), links AS (
            SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
            FROM without a JOIN without b USING (rest, pos) WHERE a.word <> b.word
            UNION SELECT a.word, a.n, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, b.n, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
        ), best AS (
            SELECT word, n, count(*) AS n_near,
                   first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
            FROM links GROUP BY word, n
        ), forms AS (
            SELECT word, form, form_n FROM best WHERE form_n >= 2 * n
        ), chains AS (
            SELECT word, form AS root FROM forms
            UNION ALL
            SELECT c.word, f.form FROM chains c JOIN forms f ON c.root = f.word
        ), roots AS (
            SELECT word, root FROM chains WHERE root NOT IN (SELECT word FROM forms)
        )
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, f.form, f.form_n,
               coalesce(root, w.word) AS root
        FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN forms f ON w.word = f.word
        LEFT JOIN roots r ON w.word = r.word
    """


ORACLE_SQL = {
    "op1_pareto_mix": _mix_sql(),
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_feistel_shards": _shards_sql(),
    "op12_turn_repair": _repair_sql(),
    "op13_spelling_variants": _spelling_sql(),
}
