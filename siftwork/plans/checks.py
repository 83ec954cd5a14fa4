"""SQL fragments shared by the checks (DuckDB dialect)."""

from __future__ import annotations

from siftwork.functions.draws import STEP, seed_state
from siftwork.functions.text import ANSWER_DROP, BLANK


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def words_sql(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '{BLANK}+'), lambda w: w <> '')"


def answer_sql(x: str) -> str:
    lowered = f"lower({trim_sql(x)})"
    return f"regexp_replace(regexp_replace({lowered}, '{BLANK}+', ' ', 'g'), '{ANSWER_DROP}', '', 'g')"


def score_sql(salt: str, key: str) -> str:
    return f"(('0x' || substr(sha256('{salt}:' || {key}), 1, 8))::BIGINT / 4294967296.0)"


def _bound(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _times(a: str, b: str) -> str:
    return f"(({a})::HUGEINT * ({b})::HUGEINT % 4294967296)::BIGINT"


def uniform_sql(seed: str, n: str) -> str:
    state = f"(({seed_state(seed)} + ({n})::HUGEINT * {STEP}) % 4294967296)::BIGINT"
    first = _times("xor(s, s >> 15)", "s | 1")
    second = f"xor(((t + {_times('xor(t, t >> 7)', 't | 61')}) % 4294967296)::BIGINT, t)"
    out = "xor(u, u >> 14) / 4294967296.0"
    return _bound("s", state, _bound("t", first, _bound("u", second, out)))


def pick_sql(seed: str, n: str, options: list[str]) -> str:
    listed = ", ".join(f"'{o}'" for o in options)
    return f"[{listed}][floor({uniform_sql(seed, n)} * {len(options)})::INT + 1]"


def text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def signature_sql(table: str, key: str, text: str) -> str:
    """CTE ``sig(ord, s)``: signature of every row as a list of hex strings."""
    return f"""words AS (SELECT {key} AS ord, {words_sql(text)} AS w FROM {table}),
grams AS (SELECT ord, CASE WHEN len(w) < 3 THEN []::VARCHAR[] ELSE list_distinct(
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM words),
seeds AS (SELECT unnest(range(0, 128)) AS h),
lows AS (SELECT ord, h, min(substr(md5(h || ':' || x), 1, 8)) AS low
    FROM (SELECT ord, unnest(g) AS x FROM grams), seeds GROUP BY 1, 2),
sig AS MATERIALIZED (SELECT ord, list(coalesce(low, 'ffffffff') ORDER BY h) AS s
    FROM (SELECT ord, h FROM grams, seeds) LEFT JOIN lows USING (ord, h) GROUP BY 1)"""


def greedy_sql(table: str, key: str, text: str, need: int = 90) -> str:
    """CTEs up to ``kept(ord)`` and ``edge(src, dst, agree)`` for the greedy rule.

    Equal signatures collapse first; pairs are compared in full.
    """
    return f"""RECURSIVE {signature_sql(table, key, text)},
copies AS (SELECT ord, min(ord) OVER (PARTITION BY s) AS first FROM sig),
reps AS MATERIALIZED (SELECT ord, s FROM sig WHERE ord IN (SELECT first FROM copies)),
slots AS MATERIALIZED (SELECT ord, unnest(range(1, 129)) AS p, unnest(s) AS v FROM reps),
edge AS MATERIALIZED (SELECT a.ord AS src, b.ord AS dst, count(*) AS agree FROM slots a JOIN slots b
    ON a.p = b.p AND a.v = b.v AND a.ord < b.ord GROUP BY 1, 2 HAVING count(*) >= {need}),
node AS (SELECT DISTINCT dst AS ord FROM edge UNION SELECT DISTINCT src FROM edge),
line AS MATERIALIZED (SELECT ord, row_number() OVER (ORDER BY ord) AS n FROM node),
walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS k
    UNION ALL
    SELECT line.n, CASE WHEN EXISTS (SELECT 1 FROM edge WHERE edge.dst = line.ord AND list_contains(walk.k, edge.src))
        THEN walk.k ELSE list_append(walk.k, line.ord) END
    FROM walk JOIN line ON line.n = walk.n + 1),
chosen AS (SELECT unnest(k) AS ord FROM (SELECT k FROM walk ORDER BY n DESC LIMIT 1)),
kept AS (SELECT ord FROM reps WHERE ord NOT IN (SELECT ord FROM node) UNION ALL SELECT ord FROM chosen)"""
