"""Byte-pair merges compiled into a deterministic transducer that counts tokens."""

from __future__ import annotations

from functools import lru_cache

#: Ends a word. No UTF-8 text holds this byte.
WORD_END = b"\xff"
#: States that are kept; when there are more, compilation starts again from the one in use.
MOST_STATES = 1 << 17
_SYMBOL = 9  # bits of a symbol in a transition's key
_EMIT, _ZERO = 16, 1 << 15  # bits of an annotation, and what stands for 0
_START = -1
_NEVER = 1 << 60


class Automaton:
    """Reads words byte by byte; transitions are annotated with the tokens they emit.

    The encoding of a prefix is always a prefix's worth of merges: its last token is
    the one token that ends there and stays apart from the last token of the prefix
    before it. So a state need hold no text: it is the node of the trie of all tokens that
    the longest unfinished token has reached, with the last token and the number of tokens at each
    place inside it. What lies before that is emitted. Equal states have equal futures, whatever
    was read, so states and transitions are numbered and tabled as words reach them.

    Counts may go down when a longer token replaces several, so annotations may be negative;
    their sum over a whole word, its end included, is its number of tokens.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], most_states: int = MOST_STATES):
        self.most_states = most_states
        self.ranks = {(bytes([b]), WORD_END): -1 for b in range(255)}
        for rank, pair in enumerate(merges):
            if WORD_END not in pair[0] and WORD_END not in pair[1].removesuffix(WORD_END):
                self.ranks.setdefault(pair, rank)
        self.tokens = [bytes([b]) for b in range(255)]
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        for left, right in self.ranks:
            if left + right not in self.halves:
                self.halves[left + right] = (left, right)
                self.tokens.append(left + right)
        self._trie()
        self._spines = lru_cache(maxsize=1 << 17)(self._spines_of)
        self.whole: dict[int, bool] = {}
        self._reset()

    def _trie(self) -> None:
        """Children, depths, failure links, and the tokens that end at each node."""
        self.child: dict[int, int] = {}
        self.depth, self.ends = [0], [-1]
        for number, token in enumerate(self.tokens):
            node = 0
            for byte in token:
                key = node << _SYMBOL | byte
                node = self.child.setdefault(key, len(self.depth))
                if node == len(self.depth):
                    self.depth.append(self.depth[key >> _SYMBOL] + 1)
                    self.ends.append(-1)
            self.ends[node] = number
        self.fail, self.shorter = [0] * len(self.depth), [0] * len(self.depth)
        for key, node in sorted(self.child.items(), key=lambda x: self.depth[x[1]]):
            above, byte = key >> _SYMBOL, key & 0xFF
            if above:
                self.fail[node] = self._goto(self.fail[above], byte)
            link = self.fail[node]
            self.shorter[node] = link if self.ends[link] >= 0 else self.shorter[link]

    def _goto(self, node: int, byte: int) -> int:
        while (found := self.child.get(node << _SYMBOL | byte)) is None:
            if not node:
                return 0
            node = self.fail[node]
        return found

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.table: dict[int, int] = {}
        self.apart: dict[tuple[int, int], bool] = {}
        self.start = self._number((0, ((_START, 0),)))

    def _number(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number

    def encode(self, raw: bytes) -> list[bytes]:
        """Tokens by the merges themselves, lowest rank first, leftmost of equals."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(pair, _NEVER), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == _NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _spines_of(self, token: bytes) -> tuple[list, list]:
        """Its first, and last, part while it is built: (part, rank of the merge that takes it)."""
        left, right, part, taken = [], [], token, _NEVER
        while True:
            left.append((part, taken))
            if part not in self.halves:
                break
            taken = self.ranks[self.halves[part]]
            part = self.halves[part][0]
        part, taken = token, _NEVER
        while True:
            right.append((part, taken))
            if part not in self.halves:
                break
            taken = self.ranks[self.halves[part]]
            part = self.halves[part][1]
        return left[::-1], right[::-1]

    def stays_apart(self, before: int, after: int) -> bool:
        """Whether two neighbouring tokens are not merged across their border.

        Only the parts at the border can meet: the last part of the first token and the first
        part of the second, as they are while both tokens are built. They merge
        if that comes before either is taken; of equal ranks the leftmost comes first.
        """
        pair = (before, after)
        if pair not in self.apart:
            last, first = self._spines(self.tokens[before])[1], self._spines(self.tokens[after])[0]
            i = j = 0
            apart = True
            while i < len(last) and j < len(first):
                (a, a_taken), (b, b_taken) = last[i], first[j]
                rank = self.ranks.get((a, b), _NEVER)
                if rank < a_taken and rank <= b_taken and rank != _NEVER:
                    apart = False
                    break
                if a_taken <= b_taken:
                    i += 1
                else:
                    j += 1
            self.apart[pair] = apart
        return self.apart[pair]

    def _is_whole(self, token: int) -> bool:
        """Whether the merges build this token from its bytes."""
        if token not in self.whole:
            self.whole[token] = self.encode(self.tokens[token]) == [self.tokens[token]]
        return self.whole[token]

    def _next(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The next state before rebasing, and the place's token and count."""
        node, places = state
        node = self._goto(node, byte)
        at = node if self.ends[node] >= 0 else self.shorter[node]
        while at:
            token = self.ends[at]
            before, count = places[len(places) - self.depth[at]]
            if self._is_whole(token) and (before == _START or self.stays_apart(before, token)):
                return (node, (*places[len(places) - self.depth[node] :], (token, count + 1))), count + 1
            at = self.shorter[at]
        raise ValueError(f"no token ends with byte {byte}")

    def compile(self, number: int, byte: int) -> int:
        """Table the transition from a state: its target and annotation, packed."""
        state = self.states[number]
        if len(self.states) >= self.most_states:
            self._reset()
            number = self._number(state)
        (node, places), count = self._next(state, byte)
        if byte == WORD_END[0]:
            target, emitted = self.start, count
        else:
            emitted = places[0][1]
            target = self._number((node, tuple((token, n - emitted) for token, n in places)))
        packed = target << _EMIT | emitted + _ZERO
        self.table[number << _SYMBOL | byte] = packed
        return packed

    def count(self, word: bytes) -> int:
        """Tokens of a word: the sum of the annotations on its path."""
        if not word:
            return 0
        table, state, total = self.table, self.start, 0
        for byte in word + WORD_END:
            packed = table.get(state << _SYMBOL | byte)
            if packed is None:
                packed = self.compile(state, byte)
                table = self.table
            state = packed >> _EMIT
            total += (packed & 0xFFFF) - _ZERO
        return total
