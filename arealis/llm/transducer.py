"""Byte-pair encoding as a deterministic transducer whose transitions carry the number of tokens that they emit.

Words are sequences of symbols: a byte, plus 256 if it closes the word.  Merges run in order of rank, the leftmost of a
rank first.  Then a sequence of tokens is the encoding of its symbols if and only if each pair of neighbours is, so after
every prefix of a word one token is the last of the prefix's encoding.  A state keeps what later symbols can ask about:
for each suffix that begins some token, the trie node of the suffix, the last token before it and the number of tokens so
far.  States are made when a text first reaches them, kept in a table, and dropped together when the table is full.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

SYMBOLS = 512
START, DEAD, WAIT = 0, 1, 2  # a word begins; no encoding; skip to the end of the word
MOST_CELLS = 1 << 24  # of the table, four bytes each
OPEN = -1  # token "before" the first one of a word


class Transducer:
    """``merges`` are pairs of earlier tokens; tokens 0 to 511 are the symbols, the others follow in order of rank."""

    def __init__(self, merges: Sequence[tuple[int, int]], most_cells: int = MOST_CELLS):
        self.parts = [None] * SYMBOLS + [tuple(m) for m in merges]
        self.pair = {tuple(m): SYMBOLS + i for i, m in enumerate(merges)}
        if any(max(m) >= SYMBOLS + i for i, m in enumerate(merges)) or len(self.pair) != len(merges):
            raise ValueError("a merge uses a token of a later merge, or occurs twice")
        self.sound = [True] * SYMBOLS
        for t, (a, b) in enumerate(self.parts[SYMBOLS:], SYMBOLS):
            self.sound.append(self.sound[a] and self.sound[b] and self._first_merge(a, b) == t)
        self.child = self._trie()
        self.longest = max(depth for _, _, _, depth in self.child.values())
        if self.longest > 255:
            raise ValueError("a token of more than 255 bytes")
        self.known: dict[int, bool] = {}
        self.column = np.full(SYMBOLS, -1, np.int16)  # of the table; symbols get one when they first occur
        self.symbol: list[int] = []
        self.most_cells = most_cells
        self.clear()

    def _trie(self) -> dict[int, tuple[int, int, bool, int]]:
        """Edges ``512 * node + symbol`` to (node, sound token there, whether longer ones follow, depth).

        A token whose symbols are never encoded as itself is left out.
        """
        spelled: list[tuple[int, ...]] = [(s,) for s in range(SYMBOLS)]
        for a, b in self.parts[SYMBOLS:]:
            spelled.append(spelled[a] + spelled[b])
        edges: dict[int, int] = {}
        token, depth, inner = [OPEN], [0], [False]
        for t, symbols in enumerate(spelled):
            if not self.sound[t]:
                continue
            node = 0
            for s in symbols:
                inner[node] = True
                to = edges.setdefault(node * SYMBOLS + s, len(token))
                if to == len(token):
                    token.append(OPEN)
                    depth.append(depth[node] + 1)
                    inner.append(False)
                node = to
            if token[node] != OPEN:
                raise ValueError("two merges give the same token")
            token[node] = t
        self.depth = depth
        return {key: (to, token[to], inner[to], depth[to]) for key, to in edges.items()}

    def clear(self) -> None:
        self.states: list[tuple] = [((0, OPEN, 0),), (), ((-1, OPEN, 0),)]
        self.number: dict[tuple, int] = {s: i for i, s in enumerate(self.states)}
        # 256 * next state + emitted tokens; -1: not made yet
        self.table = np.full((1 << 10, max(64, -(-len(self.symbol) // 32) * 32)), -1, np.int32)
        self._fixed_rows()

    def _fixed_rows(self) -> None:
        self.table[DEAD] = 256 * DEAD
        for c, s in enumerate(self.symbol):
            self.table[WAIT, c] = 256 * (WAIT if s < 256 else START)

    def columns(self, symbols: np.ndarray) -> np.ndarray:
        """Table columns of the symbols; new ones get columns of their own."""
        for s in np.flatnonzero(np.bincount(symbols, minlength=SYMBOLS)).tolist():
            if self.column[s] < 0:
                self.column[s] = len(self.symbol)
                self.symbol.append(s)
        if len(self.symbol) > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.full((len(self.table), -(-len(self.symbol) // 32) * 32 - self.table.shape[1]), -1, np.int32)], axis=1)
        self._fixed_rows()
        return self.column[symbols]

    def most_states(self) -> int:
        return max(1 << 10, self.most_cells // self.table.shape[1])

    def _first_merge(self, a: int, b: int) -> int | None:
        """The least token that merges across the boundary of ``a`` and ``b`` while both are encoded apart.

        A part of ``a`` at the boundary lasts until its own merge, which goes first among merges of the same rank since it
        stands to the left; a part of ``b`` lasts until its merge and loses to a merge of the same rank.
        """
        best, end_a, x = None, len(self.parts), a
        while True:
            end_b, y = len(self.parts), b
            while True:
                t = self.pair.get((x, y))
                if t is not None and t < end_a and t <= end_b and (best is None or t < best):
                    best = t
                if self.parts[y] is None:
                    break
                end_b, y = y, self.parts[y][0]
            if self.parts[x] is None:
                return best
            end_a, x = x, self.parts[x][1]

    def follows(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' symbols is these two tokens; any token follows ``OPEN``."""
        if a == OPEN:
            return True
        key = a << 32 | b
        got = self.known.get(key)
        if got is None:
            if len(self.known) > 1 << 20:
                self.known.clear()
            got = self.known[key] = self._first_merge(a, b) is None
        return got

    def intern(self, state: tuple) -> int:
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
            if number >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return number

    def step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """Next state and emitted tokens: those that every way to go on has behind it.

        Of the suffixes that a state keeps, the fewest tokens before one never fall again, so no transition takes tokens back.
        """
        out, hit, child, known = [], None, self.child, self.known
        for node, before, n in state:
            edge = child.get(node << 9 | symbol)
            if edge is None:
                continue
            to, t, inner, _ = edge
            if t >= 0 and (before < 0 or known.get(before << 32 | t, None) or self.follows(before, t)):
                hit = (t, n + 1)
            if inner:
                out.append((to, before, n))
        if symbol >= 256:
            return (self.states[START], hit[1]) if hit else ((), 0)
        if hit:
            out.append((0, *hit))
        base = min([n for _, _, n in out]) if out else 0
        return (tuple([(node, before, n - base) for node, before, n in out]) if base else tuple(out)), base

    def advance(self, states: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of many lanes: their next states and emitted tokens.  Numbers of states hold until the next step of any lane."""
        moves = self.table[states, columns]
        missing = moves < 0
        if missing.any():
            new = np.unique(states[missing] * SYMBOLS + columns[missing])
            if len(self.states) + len(new) > self.most_states():
                kept = {s: self.states[s] for s in np.unique(states).tolist()}
                self.clear()
                states = np.vectorize({s: self.intern(k) for s, k in kept.items()}.get, otypes=[np.int64])(states)
                new = np.unique(states * SYMBOLS + columns)
            made = []
            for key in new.tolist():
                state, column = divmod(key, SYMBOLS)
                after, emitted = self.step(self.states[state], self.symbol[column])
                made.append(256 * self.intern(after) + emitted)
            self.table[new // SYMBOLS, new % SYMBOLS] = made
            moves = self.table[states, columns]
        return moves >> 8, moves & 255

    def crossing(self, symbols: np.ndarray, first: int, cut: int) -> list[tuple[int, int, int]]:
        """Occurrences (start, end, token) of tokens that hold the last symbol before ``cut``, in the word that begins at ``first``."""
        base, out = max(first, cut - self.longest), []
        near = symbols[base : cut + self.longest].tolist()
        for i in range(cut - base):
            node = 0
            for j in range(i, len(near)):
                edge = self.child.get(node << 9 | near[j])
                if edge is None:
                    break
                node = edge[0]
                if base + j + 1 >= cut and edge[1] != OPEN:
                    out.append((base + i, base + j + 1, edge[1]))
        return out

    def tail(self, state: tuple, spent: int, cut: int, crossing: list[tuple[int, int, int]]) -> dict[int, int]:
        """Tokens up to and with each crossing one, for those that can follow; ``spent`` were emitted up to the cut."""
        seen = {self.depth[node]: (before, n) for node, before, n in state}
        out = {}
        for k, (start, end, t) in enumerate(crossing):
            if end == cut:
                if seen.get(0, (OPEN, 0))[0] == t:
                    out[k] = spent + seen[0][1]
            elif cut - start in seen:
                before, n = seen[cut - start]
                if self.follows(before, t):
                    out[k] = spent + n + 1
        return out

    def count(self, symbols: np.ndarray, chunk: int = 2048) -> np.ndarray:
        """Tokens per symbol position, so that sums over whole words are their counts; ``symbols`` end with a closed word.

        The symbols are cut into chunks of equal length wherever that falls, and all chunks are read together.  The words
        inside a chunk are counted there.  A cut inside a word is described by the tokens that can cross it: for a chunk
        the map from the tokens that enter it to those that leave it, with the tokens between, is known without its
        neighbours.  The maps are composed by a prefix scan, and one way through remains for each cut word.
        """
        n = len(symbols)
        if n == 0:
            return np.zeros(0, np.int64)
        chunk = max(chunk, 2 * self.longest)
        rows = -(-n // chunk)
        closed = np.flatnonzero(symbols >= 256)
        cuts = np.arange(1, rows) * chunk
        at = np.searchsorted(closed, cuts)
        first = np.where(at > 0, closed[at - 1] + 1, 0)  # begin of the word that holds the cut
        inside = first < cuts
        columns = self.columns(symbols)
        padded = np.zeros(rows * chunk, np.int64)
        padded[:n] = columns
        grid = np.ascontiguousarray(padded.reshape(rows, chunk).T)
        states = np.full(rows, START, np.int64)
        states[1:][inside] = WAIT
        emitted = np.zeros((chunk, rows), np.uint8)
        for i in range(chunk):
            states, emitted[i] = self.advance(states, grid[i])
        out = emitted.T.reshape(-1)[:n].astype(np.int64)
        if not inside.any():
            return out
        last = [self.states[s] for s in states]  # kept by value: numbers change when the table is cleared
        crossing = {k + 1: self.crossing(symbols, int(first[k]), int(cuts[k])) for k in np.flatnonzero(inside).tolist()}
        ends = closed[at]  # the symbol that closes the word at each cut
        heads, moves = self._chunk_maps(columns, crossing, {k: int(ends[k - 1]) for k in crossing}, chunk, rows)
        items: list[tuple[bool, dict]] = []
        for k in range(rows):
            if k in moves:
                items.append((False, moves[k]))
            else:
                tail = {}
                if k + 1 in crossing:
                    begin, cut = int(first[k]), int(cuts[k])
                    tail = self.tail(last[k], int(out[begin:cut].sum()), cut, crossing[k + 1])
                items.append((True, tail))
        for k, (_, tail) in enumerate(prefix_scan(items, compose)):
            if k + 1 in heads:
                ways = [tail[x] + heads[k + 1][x] for x in heads[k + 1] if x in tail]
                if len(ways) != 1:
                    raise ArithmeticError(f"{len(ways)} encodings of one word")
                end = int(ends[k])
                begin = int(first[k])
                out[begin : end + 1] = 0
                out[end] = ways[0]
        return out

    def _chunk_maps(self, columns: np.ndarray, crossing: dict[int, list], ends: dict[int, int], chunk: int, rows: int) -> tuple[dict, dict]:
        """Heads (crossing token: tokens after it up to the end of its word) of chunks where the word at their start ends, else maps."""
        lanes = [(k, x, e, t) for k, found in crossing.items() for x, (_, e, t) in enumerate(found)]
        stop = np.array([min(ends[k] + 1, (k + 1) * chunk) for k, *_ in lanes], np.int64)
        place = np.array([e for _, _, e, _ in lanes], np.int64)
        if len(self.states) + len(lanes) > self.most_states():
            self.clear()
        state = np.array([START if e > ends[k] else self.intern(((0, t, 0),)) for k, _, e, t in lanes], np.int64)
        total = np.zeros(len(lanes), np.int64)
        live = np.flatnonzero(place < stop)
        done: dict[int, tuple] = {}
        while len(live):
            states, spent = self.advance(state[live], columns[place[live]].astype(np.int64))
            total[live] += spent
            state[live] = states
            place[live] += 1
            over = (place[live] >= stop[live]) | (states == DEAD)
            for lane in live[over].tolist():
                done[lane] = self.states[state[lane]]
            live = live[~over]
        heads: dict[int, dict] = {}
        moves: dict[int, dict] = {}
        for lane, (k, x, e, t) in enumerate(lanes):
            end_state = done.get(lane, self.states[START] if e > ends[k] else ((0, t, 0),))
            if ends[k] < (k + 1) * chunk:
                here = heads.setdefault(k, {})
                if end_state:
                    here[x] = int(total[lane])
            else:
                here = moves.setdefault(k, {})
                if end_state:
                    here[x] = self.tail(end_state, int(total[lane]), (k + 1) * chunk, crossing[k + 1])
        return heads, moves


def compose(a: tuple[bool, dict], b: tuple[bool, dict]) -> tuple[bool, dict]:
    """First ``a``, then ``b``.  An item is (True, tokens up to each leaving token), or (False, a map from entering to leaving ones)."""
    if b[0]:
        return b

    def through(row: dict) -> dict:
        return {out: n + m for x, n in row.items() for out, m in b[1].get(x, {}).items()}

    return (True, through(a[1])) if a[0] else (False, {x: through(row) for x, row in a[1].items()})


def prefix_scan(items: list, combine: Callable) -> list:
    """All prefixes of an associative combination: pairs first, the scan of the pairs, then the places between."""
    if len(items) < 2:
        return list(items)
    pairs = prefix_scan([combine(items[i], items[i + 1]) for i in range(0, len(items) - 1, 2)], combine)
    out = [items[0]]
    for i in range(1, len(items)):
        out.append(pairs[i // 2] if i % 2 else combine(pairs[i // 2 - 1], items[i]))
    return out
