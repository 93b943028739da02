"""SQL check of the conversation repair: a row at a time from the end, with the cheapest, least audit of each state."""

# CRC-32 of a string of ASCII letters, byte by byte, from a table of 256 remainders made by eight shifts.
_SHIFT = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
_SHIFTS = "".join(f", s{i + 1} AS (SELECT b, {_SHIFT.format('v')} AS v FROM s{i})" for i in range(8))


def _best(*ways: str) -> str:
    return f"least({', '.join(ways)})"


def _way(cost: str, letter: str, behind: str, line: str = "") -> str:
    said = f"{line} || chr(10) || {behind}.t" if line else f"{behind}.t"
    return f"{{'c': {behind}.c + {cost}, 'a': '{letter}' || {behind}.a, 't': {said}}}"


_NONE = "{'c': 1000000000, 'a': '', 't': ''}"


def _row(state: int) -> str:
    """The best way on from ``state`` over one row, without turns put in before it."""
    filled, role = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[state]
    kept = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[state]
    ways = [_way("3", "D", f"b{state}")]
    ways.append(f"CASE WHEN gone THEN {_NONE} ELSE {_way('2 + late', 'R', f'b{filled}', f"'{role}:' || text")} END")
    for initial, to in kept:
        ways.append(f"CASE WHEN NOT gone AND initial = '{initial}' THEN {_way('late', 'K', f'b{to}', "role || ':' || text")} ELSE {_NONE} END")
    return _best(*ways)


def _filled(state: int, one: str = "n") -> str:
    filled, role = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[state]
    return _best(f"{one}{state}", _way("2", "I", f"{one}{filled}", f"'{role}:'"))


ORACLE = rf"""
WITH RECURSIVE s0 AS (
  SELECT b, b AS v FROM (SELECT unnest(range(256)) AS b)
){_SHIFTS}, remainders AS (
  SELECT list(v ORDER BY b) AS r FROM s8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), kinds AS (
  SELECT keyed.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(r[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind
  FROM keyed, remainders
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS next_initial
  FROM damaged
), coded AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id
), ended AS (
  SELECT {{'c': 0, 'a': '', 't': ''}} AS f, {{'c': 4, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS b1,
    {{'c': 2, 'a': 'I', 't': 'assistant:' || chr(10)}} AS b2
), walked AS (
  SELECT conv_id, n AS place, f AS b0, b1, b2, f AS b3 FROM counted, ended
  UNION ALL
  SELECT conv_id, place - 1, {_filled(0, 'm')}, {_filled(1, 'm')}, m2, m3
  FROM (
    SELECT conv_id, place, n0 AS m0, n1 AS m1, {_filled(2)} AS m2, {_filled(3)} AS m3
    FROM (
      SELECT w.conv_id, w.place, {', '.join(f'{_row(s)} AS n{s}' for s in range(4))}
      FROM (SELECT w.*, c.role, c.text, c.initial, c.fault IN ('blank', 'duplicate') AS gone,
          CASE WHEN c.fault = 'truncated' THEN 1 ELSE 0 END AS late
        FROM walked w JOIN coded c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.place = w.place) w
    )
  )
), found AS (
  SELECT conv_id, b0.c AS cost, b0.a AS audit, b0.t AS lines FROM walked WHERE place = 0
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(left(lines, greatest(length(lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""
