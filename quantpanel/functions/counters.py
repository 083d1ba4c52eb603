"""Random numbers as pure functions of integer counters, the same in NumPy and in SQL.

A counter is added to the state and the sum raised to the fifth power modulo a prime, which
permutes the numbers below it; each counter is one such round, and a number drawn from a key takes two
more. All products stay below 2^63. A lost task is recomputed to the same values.
"""

from __future__ import annotations

import numpy as np

# A prime whose predecessor 5 does not divide, and a multiplier below it.
PRIME = 2147483629
FACTOR = 1583458089


def _fifth(x):
    square = x * x % PRIME
    return square * square % PRIME * x % PRIME


def absorbed(state, counter):
    """The state with one more counter (integers or int64 arrays that broadcast)."""
    return _fifth((state + counter * FACTOR + 1) % PRIME)


def key(*counters):
    state = np.int64(0)
    for counter in counters:
        state = absorbed(state, counter)
    return state


def uniform(state, number: int):
    """The number-th draw of a key: between 0 and 1, both excluded."""
    return (_fifth((absorbed(state, number) + 2) % PRIME) + 0.5) / PRIME


def normal(state, number: int):
    """A standard normal number from the draws 2 number and 2 number + 1 (Box and Muller)."""
    return np.sqrt(-2 * np.log(uniform(state, 2 * number))) * np.cos(2 * np.pi * uniform(state, 2 * number + 1))


# --- the same in SQL, for tables with one column per state -----------------------------
def _fifth_sql(table: str, source: str, target: str) -> str:
    """``table`` with the column ``target``; intermediate columns keep the text short."""
    squared = f"SELECT *, {source} AS x_, ({source}) * ({source}) % {PRIME} AS y_ FROM ({table})"
    fourth = f"SELECT *, y_ * y_ % {PRIME} AS z_ FROM ({squared})"
    return f"SELECT * EXCLUDE (x_, y_, z_), z_ * x_ % {PRIME} AS {target} FROM ({fourth})"


def absorbed_sql(table: str, state: str, counter: str, target: str) -> str:
    """``table`` with the column ``target``: the key in ``state`` with one more counter."""
    added = f"SELECT *, ({state} + ({counter})::BIGINT * {FACTOR} + 1) % {PRIME} AS s_ FROM ({table})"
    return f"SELECT * EXCLUDE (s_) FROM ({_fifth_sql(added, 's_', target)})"


def key_sql(table: str, counters: list[str], target: str) -> str:
    """``table`` with a key of its columns ``counters`` (SQL expressions of whole numbers)."""
    table = f"SELECT *, 0::BIGINT AS k_0 FROM ({table})"
    for i, counter in enumerate(counters):
        table = f"SELECT * EXCLUDE (k_{i}) FROM ({absorbed_sql(table, f'k_{i}', counter, f'k_{i + 1}')})"
    return f"SELECT * EXCLUDE (k_{len(counters)}), k_{len(counters)} AS {target} FROM ({table})"


def uniform_sql(table: str, state: str, number: int, target: str, wanted: str = "TRUE") -> str:
    """``table`` with a uniform draw of the key in column ``state``; null unless ``wanted``."""
    one = f"SELECT *, CASE WHEN {wanted} THEN ({state} + {number * FACTOR + 1}) % {PRIME} END AS p_ FROM ({table})"
    two = f"SELECT *, (q_ + 2) % {PRIME} AS r_ FROM ({_fifth_sql(one, 'p_', 'q_')})"
    return f"SELECT * EXCLUDE (p_, q_, r_, t_), (t_ + 0.5) / {PRIME} AS {target} FROM ({_fifth_sql(two, 'r_', 't_')})"


def normal_sql(table: str, state: str, number: int, target: str, wanted: str = "TRUE") -> str:
    both = uniform_sql(uniform_sql(table, state, 2 * number, "u_", wanted), state, 2 * number + 1, "v_", wanted)
    return f"SELECT * EXCLUDE (u_, v_), sqrt(-2 * ln(u_)) * cos(2 * pi() * v_) AS {target} FROM ({both})"
