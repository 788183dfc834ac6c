"""Smallest windows of lines, which together cover every run of lines that is large enough."""

from __future__ import annotations

from collections.abc import Sequence


def smallest(words: Sequence[int], min_lines: int, min_words: int) -> list[tuple[int, int]]:
    """(first, last) of the smallest windows from each first line on and back from each last line, in order.

    A window has ``min_lines`` lines and ``min_words`` words at least.  It begins with a
    line that has words and ends with one, or with the line behind one, so a stretch of
    blank lines makes no windows of its own.  Every run of this form is covered by the
    windows inside it: lines up to the end of its first line's window by that window,
    every other line by the window back from it (or from the next line that may end one).
    """
    total = [0]
    for n in words:
        total.append(total[-1] + n)
    ends = [i for i, n in enumerate(words) if n or i and words[i - 1]]
    starts = [i for i, n in enumerate(words) if n]
    enough = lambda a, b: b - a + 1 >= min_lines and total[b + 1] - total[a] >= min_words
    found, k = set(), 0
    for a in starts:
        while k < len(ends) and not enough(a, ends[k]):
            k += 1
        if k == len(ends):
            break
        found.add((a, ends[k]))
    k = -1
    for b in ends:
        while k + 1 < len(starts) and enough(starts[k + 1], b):
            k += 1
        if k >= 0:
            found.add((starts[k], b))
    return sorted(found)
