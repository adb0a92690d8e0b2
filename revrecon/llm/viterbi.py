"""Cheapest repair of a sequence of roles: one step of the cost vectors, runs over a chunk, and the least audit.

A repaired sequence reads ``(s?(ua)+)?``. What stands so far is one of four states: nothing (E), the system turn (S), a
user turn last (U), an assistant turn last (A). A cost vector holds, for each state, what the rest of the rows costs.
"""

from __future__ import annotations

#: States, costs of the edits, and what a truncated row that stays costs.
E, S, U, A = range(4)
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Kinds of a row by the first letter of its role; LATE is added for a truncated row.
SYSTEM, USER, ASSISTANT, OTHER, LATE = 0, 1, 2, 3, 4
#: The state after the only turn that may follow (for a rerole or an insert), and that turn's role.
FOLLOWS, ROLE_OF = (U, U, A, U), {U: "user", A: "assistant"}
#: Costs where no row is left: a sequence may end as nothing or after an assistant turn.
FINAL = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def kind_of(role: str) -> int:
    return "sua".find(role[:1]) if role[:1] and role[:1] in "sua" else OTHER


def step(row: int, after: Vector) -> Vector:
    """The vector before a row, inserts in front of it included, from the vector after it."""
    kind, late = row % LATE, TRUNCATED if row >= LATE else 0
    e, s, u, a = after
    to_u = late + u + (0 if kind == USER else REROLE)
    to_a = late + a + (0 if kind == ASSISTANT else REROLE)
    e, s = min(DELETE + e, to_u), min(DELETE + s, to_u)
    if kind == SYSTEM:
        e = min(e, late + after[S])
    u, a = min(DELETE + u, to_a), min(DELETE + a, to_u)
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(e, INSERT + u), min(s, INSERT + u), u, a


def normal(v: Vector) -> tuple[Vector, int]:
    """The vector with least entry 0, and what was taken off."""
    least = min(v)
    return (v[0] - least, v[1] - least, v[2] - least, v[3] - least), least


def run(rows: bytes, tail: Vector) -> Vector:
    """The vector before the first row."""
    v = tail
    for row in reversed(rows):
        v = step(row, v)
    return v


def rerun(rows: bytes, tail: Vector, known_tail: Vector, known_head: Vector) -> tuple[Vector, int]:
    """As :func:`run`, beside a run whose end is known: it stops where both vectors differ by a constant only.

    Also gives the number of rows that were stepped over.
    """
    v, w = tail, known_tail
    for done, row in enumerate(reversed(rows)):
        apart = v[0] - w[0]
        if apart == v[1] - w[1] == v[2] - w[2] == v[3] - w[3]:
            return tuple(x + apart for x in known_head), done  # type: ignore[return-value]
        v, w = step(row, v), step(row, w)
    return v, len(rows)


def trail(rows: bytes, tail: Vector) -> list[Vector]:
    """The vectors before each row and after the last."""
    out = [tail]
    for row in reversed(rows):
        out.append(step(row, out[-1]))
    return out[::-1]


def trace(rows: bytes, vectors: list[Vector], state: int, last: bool) -> tuple[list[str], int]:
    """The least audit of the cheapest edits from a state, a text per row (inserts first), and the state after it.

    Letters are taken in ASCII order wherever the costs allow them. A state and a letter leave one next state, so no
    two cheapest repairs share an audit. After the ``last`` chunk of a sequence the closing inserts are one text more.
    """
    out = []
    for row, here, after in zip(rows, vectors[:-1], vectors[1:], strict=True):
        kind, late, text = row % LATE, TRUNCATED if row >= LATE else 0, ""
        while True:
            goal, follow = here[state], FOLLOWS[state]
            if goal == DELETE + after[state]:
                text += "D"
                break
            if goal == INSERT + here[follow]:
                text, state = text + "I", follow
                continue
            if kind == SYSTEM and state == E and goal == late + after[S]:
                text, state = text + "K", S
                break
            same = kind == (USER if follow == U else ASSISTANT)
            text, state = text + ("K" if same else "R"), follow
            break
        out.append(text)
    if last:
        closing = {E: "", S: "II", U: "I", A: ""}[state]
        out.append(closing)
        state = E if state == E else A
    return out, state
