"""Cheapest edits of a conversation and the ASCII-least audit among them.

A conversation comes as a byte per row: `4 * fault + initial`. A node is (rows read, state); the
states are what the repaired roles look like so far. Arcs are edits: Delete, Keep and Rerole read a
row, Insert does not. Costs to go are worked out backwards, row by row. The arcs that hold a
node's cost make an acyclic graph, and every path in it is a cheapest sequence of edits.

The least audit is found by prefix doubling. Nodes are ranked by the first letter of their least
audit; from ranks by 2^k letters follow those by 2^(k+1), as the rank of a node paired with that of
the node its pointer, 2^k letters on, leads to. A letter leads from a node to one node at most, so
a pointer is a single node. When all pointers have reached an end, ranks order the nodes by whole
audits and select the arc of each node, and the doubled pointers read off the path.

Graphs of many conversations are ranked side by side. One of more than `SEGMENT` rows is cut: the
costs at the cuts come first, then a segment at a time is ranked, so beyond its bytes and its audit
only one segment is in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# The classes of role initials, the faults of a row, and the letters in ASCII order.
INITIALS = ("s", "u", "a", "")
FAULTS = ("", "blank", "duplicate", "truncated")
LETTERS = "DIKR"
INSERT, DELETE, REROLE, TRUNCATED = 3, 4, 3, 3
# Initials that may stand side by side.
LEGAL_PAIRS = ("su", "ua", "au")

# States: nothing yet, after s, after u, after a. Only the first and the last may end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FAR = 1 << 60
END = (0, FAR, FAR, 0)
# Where a user or an assistant leads, whichever the state asks for.
TURN = (USER, USER, ASSISTANT, USER)

SEGMENT = 4096
# Conversations up to so many rows are ranked side by side, about so many nodes at a time.
SHORT = 64
NODES = 1 << 16


def _kept(initial: int) -> tuple[int, ...]:
    """The state that keeping a row of this initial leads to from each state; -1 if it may not stay."""
    after = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
    ways = after.get(INITIALS[initial], {})
    return tuple(ways.get(state, -1) for state in range(STATES))


CODES = range(len(FAULTS) * len(INITIALS))
KEPT = np.array([_kept(code % 4) for code in CODES])
GOES = np.array([FAULTS[code // 4] in ("blank", "duplicate") for code in CODES])
EXTRA = np.array([TRUNCATED if FAULTS[code // 4] == "truncated" else 0 for code in CODES])
KEPT[GOES] = -1


def _with_inserts(costs: Sequence[int]) -> list[int]:
    """Costs to go before a row, or at the end, when rows may be inserted there first."""
    once = [min(c, INSERT + costs[TURN[s]]) for s, c in enumerate(costs)]
    return [min(c, INSERT + once[TURN[s]]) for s, c in enumerate(once)]


def costs_to_go(codes: bytes, end: Sequence[int]) -> list[list[int]]:
    """Costs of every layer from the first row to the end, whose costs are `end`."""
    layers = [list(end)]
    for code in reversed(codes):
        behind = layers[-1]
        costs = [DELETE + c for c in behind]
        if not GOES[code]:
            extra, kept = int(EXTRA[code]), KEPT[code]
            for state in range(STATES):
                costs[state] = min(costs[state], REROLE + extra + behind[TURN[state]])
                if kept[state] >= 0:
                    costs[state] = min(costs[state], extra + behind[kept[state]])
        layers.append(_with_inserts(costs))
    layers.reverse()
    return layers


class Segment:
    """Rows in a row of one conversation, with the costs at their end."""

    def __init__(self, codes: bytes, end: Sequence[int], last: bool):
        self.codes, self.last = codes, last
        self.layers = costs_to_go(codes, end)


def least_paths(segments: Sequence[Segment], starts: Sequence[int]) -> list[tuple[str, int]]:
    """For each segment and the state it is entered in: the least audit and the state at its end."""
    sizes = np.array([len(s.layers) for s in segments])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    cost = np.array([c for s in segments for c in s.layers], dtype=np.int64).reshape(-1)
    code = np.concatenate([np.frombuffer(s.codes + b"\xff", np.uint8) for s in segments]).astype(np.int64)
    layer = np.repeat(np.arange(len(code)), STATES)
    state = np.tile(np.arange(STATES), len(code))
    reads = code[layer] != 255
    row = np.where(reads, code[layer], 0)
    open_end = np.repeat(np.array([s.last for s in segments]), sizes)[layer]
    next_row = np.minimum(layer + 1, len(code) - 1)
    turn = np.array(TURN)[state]
    kept, stays = KEPT[row, state], ~GOES[row]
    # Target, cost and whether there is such an arc, by letter.
    arcs = [
        (next_row * STATES + state, np.full(len(layer), DELETE), reads),
        (layer * STATES + turn, np.full(len(layer), INSERT), reads | open_end),
        (next_row * STATES + np.maximum(kept, 0), EXTRA[row], reads & (kept >= 0)),
        (next_row * STATES + turn, REROLE + EXTRA[row], reads & stays),
    ]
    holds = [there & (cost == price + cost[target]) for target, price, there in arcs]
    here = np.arange(len(layer))

    def selected(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letter (0 at an end) and target of each node's arc that is least by letter and rank."""
        nothing = np.iinfo(np.int64).max
        best, to = np.full(len(layer), nothing), here.copy()
        for letter, ((target, _, _), held) in enumerate(zip(arcs, holds, strict=True), start=1):
            key = np.where(held, letter * (len(layer) + 1) + rank[target], nothing)
            to = np.where(key < best, target, to)
            best = np.minimum(best, key)
        return np.where(best == nothing, 0, best // (len(layer) + 1)), to

    rank, to = selected(np.zeros(len(layer), np.int64))
    pointers = [to]
    while True:
        pairs = rank * (len(layer) + 1) + rank[pointers[-1]]
        rank = np.unique(pairs, return_inverse=True)[1]
        doubled = pointers[-1][pointers[-1]]
        if np.array_equal(doubled, pointers[-1]):
            break
        pointers.append(doubled)
    letter, to = selected(rank)
    pointers[0] = to
    # Column t holds the nodes after t letters; each pointer doubles the columns that are known.
    at = (first * STATES + np.array(starts))[:, None]
    for pointer in pointers:
        at = np.concatenate([at, pointer[at]], axis=1)
    names = np.frombuffer(b"\0" + LETTERS.encode(), np.uint8)[letter[at]]
    return [
        (names[k].tobytes().rstrip(b"\0").decode(), int(state[at[k, -1]]))
        for k in range(len(segments))
    ]


def _long(codes: bytes, segment: int) -> tuple[int, str]:
    """Cost and audit of a conversation, one segment at a time."""
    cuts = list(range(0, len(codes), segment)) or [0]
    ends: list[Sequence[int]] = [_with_inserts(END)]
    for cut in reversed(cuts[1:]):
        ends.append(costs_to_go(codes[cut : cut + segment], ends[-1])[0])
    ends.reverse()
    audit, state, cost = [], NOTHING, None
    for cut, end in zip(cuts, ends, strict=True):
        part = Segment(codes[cut : cut + segment], end, cut == cuts[-1])
        cost = part.layers[0][state] if cost is None else cost
        ((letters, state),) = least_paths([part], [state])
        audit.append(letters)
    return cost, "".join(audit)


def cheapest_edits(
    conversations: Sequence[bytes], segment: int = SEGMENT
) -> Iterator[tuple[int, str]]:
    """Cost and least audit of each conversation, in their order."""
    end = _with_inserts(END)
    batch: list[Segment] = []
    held = 0

    def ranked() -> Iterator[tuple[int, str]]:
        nonlocal held
        if batch:
            paths = least_paths(batch, [NOTHING] * len(batch))
            yield from ((s.layers[0][NOTHING], audit) for s, (audit, _) in zip(batch, paths, strict=True))
            batch.clear()
            held = 0

    for codes in conversations:
        if len(codes) > min(SHORT, segment):
            yield from ranked()
            yield _long(codes, segment)
            continue
        batch.append(Segment(codes, end, True))
        held += (len(codes) + 1) * STATES
        if held > NODES:
            yield from ranked()
    yield from ranked()


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired rows (role, text), made as `rows` come."""
    state = NOTHING
    names = {USER: "user", ASSISTANT: "assistant"}
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = int(_KEPT_BY_INITIAL[role[:1]][state])
        else:
            state = TURN[state]
            role = names[state]
        yield role, text


_KEPT_BY_INITIAL = {name: _kept(k) for k, name in enumerate(INITIALS)}
