"""Byte-pair merges as a left-to-right transducer.

In byte-pair encoding the encoding of a prefix ends in one token that depends on the prefix alone, and a
sequence of tokens is an encoding exactly if each neighbouring pair encodes to itself. So a machine that
reads one symbol at a time needs as state only the last token after each of the latest ``longest`` symbols.
The merge loop itself runs on pairs of tokens only, to decide whether they may stand next to each other.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

#: In place of a piece: nothing stands before, or a symbol that no piece has.
START, UNKNOWN = -1, 0


class Merges:
    """Merge rules over symbols (characters of a str).

    ``ranks`` gives a merged piece its priority, the lowest first. ``splits`` names the length of the left
    part where only one split of a piece is a rule; without it any two neighbours that form a piece merge.
    ``alphabet`` names symbols that are pieces though no rule has them.
    """

    def __init__(self, ranks: dict[str, int], splits: dict[str, int] | None = None, alphabet: Iterable[str] = ()):
        self.ranks, self.splits = ranks, splits
        self.longest = max(map(len, ranks), default=1)
        kept = [p for p in ranks if self.merged(p) == [p]]
        singles = {*alphabet, *(c for p in ranks for c in p)} - set(kept)
        self.names = ["", *kept, *sorted(singles)]
        self.ids = {p: i for i, p in enumerate(self.names) if i}
        self.sizes = [len(p) or 1 for p in self.names]
        self.fits: dict[int, bool] = {}
        self.prefixes = {p[:i] for p in self.ids for i in range(1, len(p) + 1)}
        self.nodes: dict[str, int] = {"": 0}
        self.node_names = [""]
        self.steps: list[dict[str, tuple[int, tuple[tuple[int, int], ...]]]] = [{}]

    def step(self, node: int, symbol: str) -> tuple[int, tuple[tuple[int, int], ...]]:
        """Next node and the pieces that may end here as (length, id), longest first.

        A node is the longest suffix read so far that begins a piece. Transitions are made when first taken.
        """
        suffix = self.node_names[node] + symbol
        while suffix and suffix not in self.prefixes:
            suffix = suffix[1:]
        ends = [(len(p), self.ids[p]) for p in (suffix[i:] for i in range(len(suffix))) if p in self.ids]
        if suffix not in self.nodes:
            self.nodes[suffix] = len(self.node_names)
            self.node_names.append(suffix)
            self.steps.append({})
        made = self.nodes[suffix], tuple(ends) or ((1, UNKNOWN),)
        if len(self.steps[node]) < 4096:
            self.steps[node][symbol] = made
        return made

    def rank(self, a: str, b: str) -> int | None:
        r = self.ranks.get(a + b)
        return None if r is None or (self.splits is not None and self.splits[a + b] != len(a)) else r

    def merged(self, text: str) -> list[str]:
        """The merge loop: best rank first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best = at = None
            for i in range(len(parts) - 1):
                r = self.rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, a: int, b: int) -> bool:
        """Whether pieces a and b stay two tokens when they meet; a symbol without a piece merges with none."""
        if len(self.fits) >= 1 << 18:
            self.fits.clear()
        left, right = self.names[max(a, UNKNOWN)], self.names[b]
        ok = self.fits[a * len(self.names) + b] = not (left and right) or self.merged(left + right) == [left, right]
        return ok

    def sufficient_lookahead(self) -> int:
        """Symbols beyond a token's start that can still change it, bounded from the merge list.

        A merge u+v is undone only by an earlier rule whose left part ends v's text and reaches past it, and
        that one only by a still earlier rule, and so on: ranks fall along the chain. The longest chain is
        found in one pass over the rules by rank, with the best length so far kept per left part.
        """
        best: dict[str, tuple[list[int], list[int]]] = {}
        made: dict[str, tuple[str, str]] = {}
        most = 1
        for piece, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            cut = self.splits[piece] if self.splits is not None else None
            pairs = [(piece[:cut], piece[cut:])] if cut else [(piece[:i], piece[i:]) for i in range(1, len(piece))]
            for u, v in pairs:
                reach, tail, limit = len(piece), v, rank
                while tail:
                    ranks, lengths = best.get(tail, ((), ()))
                    if k := bisect_left(ranks, limit):
                        reach = max(reach, len(piece) + lengths[k - 1])
                    limit = self.ranks.get(tail, 0)
                    tail = made[tail][1] if tail in made else ""
                ranks, lengths = best.setdefault(u, ([], []))
                beyond = reach - len(u)
                if not lengths or beyond > lengths[-1]:
                    if ranks and ranks[-1] == rank:
                        lengths[-1] = beyond
                    else:
                        ranks.append(rank)
                        lengths.append(beyond)
                most = max(most, reach)
            if len(parts := self.merged_last(piece)) == 2:
                made[piece] = parts
        return most

    def merged_last(self, piece: str) -> tuple[str, ...]:
        """The two parts that the piece's own last merge joins."""
        if self.splits is not None:
            return piece[: self.splits[piece]], piece[self.splits[piece] :]
        for i in range(1, len(piece)):
            a, b = piece[:i], piece[i:]
            if (len(a) == 1 or self.ranks.get(a, 1 << 60) < self.ranks[piece]) and (len(b) == 1 or self.ranks.get(b, 1 << 60) < self.ranks[piece]):
                return a, b
        return ()


class Machine:
    """The transducer's state while it reads one stretch of symbols.

    ``last`` and ``count`` hold, per position, the piece that ends there and the tokens emitted up to there.
    ``stable`` drops what can no longer change, so memory depends on the merge list only.
    """

    __slots__ = ("rules", "node", "last", "count", "weigh")

    def __init__(self, rules: Merges, weigh=None):
        self.rules, self.node, self.last, self.count, self.weigh = rules, 0, [START], [0], weigh

    def read(self, symbols: str) -> int:
        """Reads on; returns by how many tokens the encoding of all that was read has grown."""
        rules, last, count, node, weigh = self.rules, self.last, self.count, self.node, self.weigh
        steps, fits, known, before = rules.steps, rules.fits.get, len(rules.names), count[-1]
        push, add = last.append, count.append
        for symbol in symbols:
            hit = steps[node].get(symbol)
            node, ends = hit or rules.step(node, symbol)
            for length, piece in ends:
                if length <= len(last):
                    left = last[-length]
                    ok = fits(left * known + piece)
                    if ok or (ok is None and rules.neighbours(left, piece)):
                        break
            push(piece)
            add(count[-length] + (1 if length > 1 or weigh is None else weigh(symbol)))
        self.node = node
        return count[-1] - before

    def stable(self) -> list[int]:
        """Takes out the pieces that no continuation can change.

        A token is at most ``longest`` symbols long, so every continuation passes one of the latest
        ``longest`` positions; what all their paths share is final.
        """
        n, last, sizes = len(self.last) - 1, self.last, self.rules.sizes
        open_at = set(range(max(0, n - self.rules.longest + 1), n + 1))
        while len(open_at) > 1:
            at = max(open_at)
            open_at.remove(at)
            open_at.add(at - sizes[last[at]])
        return self._cut(open_at.pop())

    def finish(self) -> list[int]:
        return self._cut(len(self.last) - 1)

    def _cut(self, at: int) -> list[int]:
        out, i, last, sizes = [], at, self.last, self.rules.sizes
        while i > 0:
            out.append(last[i])
            i -= sizes[last[i]]
        if at:
            del self.last[:at], self.count[:at]
        return out[::-1]
