"""Packing by bin completion with branch and bound, on counts per length.

How documents fit together depends on their lengths only, of which there are at
most as many as a sequence has tokens. The search therefore works on the number of
documents per length, however many documents there are, and returns patterns: so
many sequences, each filled with so many documents of these lengths.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from itertools import accumulate

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # sequences, ((length, documents), ...)

FILLINGS = 6  # completions kept per sequence at first
FILLING_NODES = 1500  # nodes of the enumeration of one sequence's completions
SEARCH_NODES = 20_000  # nodes of the search over sequences
SEARCH_WORK = 1_500_000  # nodes of all the completions that one search enumerates


def best_fit(counts: dict[int, int], size: int) -> list[Pattern]:
    """Best-fit decreasing: each document into the fullest sequence that takes it."""
    open_by_rest: dict[int, list[Pattern]] = defaultdict(list)
    rests: list[int] = []  # sorted
    full: list[Pattern] = []

    def put(rest: int, n: int, fill: tuple) -> None:
        if not rest:
            full.append((n, fill))
            return
        if rest not in open_by_rest:
            rests.insert(bisect_right(rests, rest), rest)
        open_by_rest[rest].append((n, fill))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(rests, length - 1)
            if at == len(rests):  # open new sequences, filled with as many as go in
                per = min(size // length, left)
                n = left // per
                put(size - per * length, n, ((length, per),))
                left -= n * per
                continue
            rest = rests[at]
            n, fill = open_by_rest[rest].pop()
            if not open_by_rest[rest]:
                del open_by_rest[rest]
                rests.pop(at)
            per = min(rest // length, left)
            used = min(n, left // per)
            if used < n:
                put(rest, n - used, fill)
            put(rest - per * length, used, (*fill, (length, per)))
            left -= used * per
    return full + [p for ps in open_by_rest.values() for p in ps]


def sequences(patterns: list[Pattern]) -> int:
    return sum(n for n, _ in patterns)


def lower_bound(counts: dict[int, int], size: int) -> int:
    """Sequences that any packing needs at least.

    The greatest of two bounds. For every limit k up to size / 2 (Martello and Toth):
    documents over size - k are alone, those over size / 2 have a sequence each, and
    what the latter leave over takes no more than their rest of the documents from k
    to size / 2; k = 0 gives total / size. For every m: documents over size / (m + 1)
    go m at most into one sequence.
    """
    number, total = [0] * (size + 2), [0] * (size + 2)  # of the documents shorter than the place
    for length in range(size + 1):
        n = counts.get(length, 0)
        number[length + 1], total[length + 1] = number[length] + n, total[length] + n * length
    half, least = size // 2, 0
    for k in range(half + 1):
        alone = number[size + 1] - number[size - k + 1]
        paired = number[size - k + 1] - number[half + 1]
        small = total[half + 1] - total[k]
        room = paired * size - (total[size - k + 1] - total[half + 1])
        least = max(least, alone + paired + max(0, -(-(small - room) // size)))
    for m in range(1, size + 1):
        n = number[size + 1] - number[size // (m + 1) + 1]
        least = max(least, -(-n // m))
    return least


def fillings(
    lengths: list[int], counts: dict[int, int], room: int, most_waste: int, keep: int = FILLINGS, whole: bool = False, most_only: bool = False, spent: list[int] | None = None
) -> list[tuple[int, tuple]]:
    """Undominated ways to fill ``room``, least waste first: (waste, ((length, n), ...)).

    Depth first from the largest length that fits, with every number of documents
    of it from the most that fit down to none. A way that leaves room for a document
    still there is dominated by the one with it and is not kept; a branch is cut
    where all shorter documents together cannot bring the waste down to what is
    allowed. The ``keep`` ways of least waste are returned, of those met within
    FILLING_NODES nodes; unless ``whole``, a way without waste ends the enumeration.
    ``spent`` counts the nodes. ``most_only`` looks at the most documents of a length and at none only, which
    reaches more different lengths within the nodes.
    """
    best: list[tuple[int, tuple]] = []
    upto = [0, *accumulate(length * counts[length] for length in lengths)]  # total of the shortest ones
    nodes = 0

    def go(rest: int, below: int, chosen: tuple, skipped: int) -> bool:
        """``skipped``: the smallest length passed over of which documents are left."""
        nonlocal nodes
        nodes += 1
        at = min(bisect_right(lengths, rest), below) - 1
        while True:
            while at >= 0 and not counts[lengths[at]]:
                at -= 1
            most = min(best[-1][0] - 1 if len(best) == keep else most_waste, skipped - 1)
            if rest - upto[at + 1] > most:
                return False
            if at < 0:
                best.append((rest, chosen))
                best.sort(key=lambda w: (w[0], sum(n for _, n in w[1])))
                del best[keep:]
                return not rest and not whole
            if nodes > FILLING_NODES and best:
                return True
            length = lengths[at]
            fit = min(counts[length], rest // length)
            for n in range(fit, fit - 1 if most_only and fit else 0, -1):
                left = length if n < counts[length] else skipped
                if go(rest - n * length, at, (*chosen, (length, n)), left):
                    return True
            skipped = length  # passed over
            at -= 1

    go(room, len(lengths), (), room + 1)
    if spent is not None:
        spent[0] += nodes + len(lengths) // 10
    return best


def pack(counts: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that place every document, in as few sequences as the search finds.

    The incumbent is best-fit decreasing. The search completes the sequence around
    the largest document left, applies a completion to as many sequences at once as
    the counts allow, and cuts a branch when its waste so far exceeds what an
    improvement on the incumbent can afford. The first search looks at completions
    with the most documents of a length or none, the second at every number of them;
    the third, where a branch leads to no improvement, comes back and tries all completions, each also on fewer
    sequences down to one. If the incumbent reaches ``lower_bound`` it is
    optimal and the search ends; otherwise each search ends after SEARCH_NODES nodes, or after
    SEARCH_WORK nodes of completions (a tenth of a node for every length), with the best
    solution so far, which always holds every document.
    """
    counts = {length: n for length, n in counts.items() if n}
    if any(not 0 < length <= size for length in counts):
        raise ValueError("a length is outside the sequence size")
    least, best = lower_bound(counts, size), best_fit(counts, size)
    for most_only, thorough in ((True, False), (False, False), (False, True)):
        if sequences(best) > least:
            best = search(counts, size, best, least, most_only, thorough)
    return best


def search(counts: dict[int, int], size: int, best: list[Pattern], least: int, most_only: bool, thorough: bool) -> list[Pattern]:
    """``best`` or a packing in fewer sequences, ``least`` ones at least, by one of the searches of ``pack``."""
    total = sum(length * n for length, n in counts.items())
    left = dict(counts)
    lengths = sorted(left)
    used = waste = nodes = 0
    rest, spent = total, [0]

    def choices(whole: bool) -> list:
        """(waste, filling, sequences), the latter the most that can be or, if ``whole``, also fewer."""
        top = next((length for length in reversed(lengths) if left[length]), None)
        if top is None:
            return []
        left[top] -= 1
        room = size - top
        most = min(room, (sequences(best) - 1) * size - total - waste)
        ways = fillings(lengths, left, room, most, FILLING_NODES if whole else FILLINGS, whole, most_only, spent) if most >= 0 else []
        left[top] += 1
        out = []
        for w, way in ways:
            need = defaultdict(int, dict(way))
            need[top] += 1
            n = min(left[x] // c for x, c in need.items())
            while n:
                out.append((w, tuple(sorted(need.items(), reverse=True)), n))
                n = n // 2 if whole else 0
        return out

    stack: list[list] = [[choices(False), 0, None, not thorough]]  # [choices, next choice, applied pattern or None, all choices]
    while stack and nodes < SEARCH_NODES and spent[0] < SEARCH_WORK:
        frame = stack[-1]
        if frame[2]:  # undo
            w, fill, n = frame[2]
            used, waste = used - n, waste - w * n
            for length, c in fill:
                left[length] += c * n
                rest += length * c * n
            frame[2] = None
        affordable = (sequences(best) - 1) * size - total
        if frame[1] >= len(frame[0]) or waste + frame[0][frame[1]][0] > affordable:
            if frame[3]:
                stack.pop()
            else:
                tried = set(frame[0])
                frame[0], frame[1], frame[3] = [c for c in choices(True) if c not in tried], 0, True
                nodes += 1
            continue
        w, fill, n = frame[0][frame[1]]
        frame[1] += 1
        nodes += 1
        if w:  # the bound may not allow all of them at once
            n = max(1, min(n, (affordable - waste) // w))
        used, waste = used + n, waste + w * n
        for length, c in fill:
            left[length] -= c * n
            rest -= length * c * n
        frame[2] = (w, fill, n)
        if not rest:
            best = [(f[2][2], f[2][1]) for f in stack]
            if sequences(best) <= least:
                break
            continue
        if used + -(-rest // size) < sequences(best):
            stack.append([choices(False), 0, None, not thorough])
    return best
