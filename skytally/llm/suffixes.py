"""Suffix order of many small sets of strings by linear grouping.

A suffix's Lyndon prefix is the longest prefix that is smaller than all its own proper suffixes. Suffixes are grouped by
it in one pass over the groups, greatest first; a second pass, smallest first, orders the members of each group. No
group is renamed and nothing recurs. Every step works on one group of every set at once, so the arrays of a step are as
long as there are sets, and the number of steps is the largest number of groups that a set has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

POSITIONS = 1 << 20  # of all strings that are ordered side by side


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` (``sizes[0]`` numbers), then those of the next one, and so on."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin."""
    new = np.empty(len(keys[0]), bool)
    new[:1] = True
    np.not_equal(keys[0][1:], keys[0][:-1], out=new[1:])
    for more in keys[1:]:
        new[1:] |= more[1:] != more[:-1]
    return np.flatnonzero(new)


def lengths_of(starts: np.ndarray, end: int) -> np.ndarray:
    """The lengths of runs, the last of which ends at ``end``."""
    out = np.empty_like(starts)
    np.subtract(starts[1:], starts[:-1], out=out[:-1])
    out[-1:] = end - starts[-1:]
    return out


@dataclass
class Suffixes:
    """Sets of strings, each string followed by an end mark that is smaller than all bytes."""

    marks: np.ndarray  # position of each string's end mark
    first: np.ndarray  # first slot of each set; a set's positions are its slots
    head: np.ndarray  # how many end marks a set has; they take its first slots
    last: np.ndarray  # end of each set's slots
    order: np.ndarray  # position in each slot
    slot: np.ndarray  # and the reverse
    group: np.ndarray  # first slot of each position's group
    size: np.ndarray  # of the group that begins at a slot
    previous: np.ndarray  # the nearest smaller suffix before, -1: none
    end: np.ndarray  # where the Lyndon prefix ends: the next smaller suffix
    touched: np.ndarray  # scratch, false between steps

    @classmethod
    def of(cls, strings: list[bytes], sets: np.ndarray) -> Suffixes:
        """``sets`` tells the set of each string, ascending. At first a group holds the suffixes of one first byte."""
        sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
        text = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.int64) + 1
        marks = np.cumsum(sizes) - 1
        text[marks] = 0
        n = len(text)
        starts = run_starts(sets)
        first = (marks - sizes + 1)[starts]
        head = lengths_of(starts, len(sets))
        keys = np.repeat(np.arange(len(first)), lengths_of(first, n)) * 257 + text
        order = np.argsort(keys, kind="stable")
        slot = np.empty(n, np.int64)
        slot[order] = np.arange(n)
        begins = run_starts(keys[order])
        lengths = lengths_of(begins, n)
        size = np.zeros(n, np.int64)
        size[begins] = lengths
        group = np.empty(n, np.int64)
        group[order] = np.repeat(begins, lengths)
        previous = np.arange(-1, n - 1)
        previous[marks - sizes + 1] = -1
        return cls(marks, first, head, first + lengths_of(first, n), order, slot, group, size, previous,
                   np.arange(1, n + 1), np.zeros(n, bool))

    def group_by_lyndon_prefix(self) -> None:
        """Phase 1: groups, greatest first, lengthen the Lyndon prefixes of the suffixes that point to them.

        A member's previous smaller suffix is found over the pointers of greater groups. The Lyndon prefix of what
        several members point to goes on with all of them: of a group, those with more such members are greater.
        """
        low, done = self.first + self.head, self.last.copy()
        open_ = np.flatnonzero(done > low)
        while len(open_):
            end = done[open_]
            begin = self.group[self.order[end - 1]]
            members = self.order[ragged(begin, end - begin)]
            parents = self._previous_smaller(members, np.repeat(begin, end - begin))
            found = parents >= 0
            if found.any():
                self._split(parents[found], members[found])
            done[open_] = begin
            open_ = open_[begin > low[open_]]

    def _previous_smaller(self, members: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Pointers of the members of one group a set: to the nearest position before that is in a lower group."""
        at = self.previous[members]
        todo = np.flatnonzero(at >= 0)
        while len(todo):
            todo = todo[self.group[at[todo]] >= own[todo]]
            # Pointers of members of the same group move on side by side.
            at[todo] = self.previous[at[todo]]
            self.previous[members[todo]] = at[todo]
            todo = todo[at[todo] >= 0]
        return at

    def _split(self, parents: np.ndarray, members: np.ndarray) -> None:
        """Move what was pointed to behind the rest of its group, by the number of pointers."""
        by_parent = np.argsort(parents, kind="stable")
        parents, ends = parents[by_parent], self.end[members[by_parent]]
        starts = run_starts(parents)
        touched, times = parents[starts], lengths_of(starts, len(parents))
        self.end[touched] = np.maximum.reduceat(ends, starts)

        home = self.group[touched]
        by_home = np.argsort(home * (int(times.max()) + 1) + times)
        touched, times, home = touched[by_home], times[by_home], home[by_home]
        runs = run_starts(home)
        counts = lengths_of(runs, len(home))
        of_run = home[runs]
        tails = of_run + self.size[of_run] - counts
        slots = ragged(tails, counts)
        held = self.order[slots]
        from_ = self.slot[touched]
        outside = from_[from_ < np.repeat(tails, counts)]
        self.touched[touched] = True
        moved = held[~self.touched[held]]
        self.touched[touched] = False
        self.order[outside], self.slot[moved] = moved, outside
        self.order[slots], self.slot[touched] = touched, slots

        self.size[of_run] -= counts
        parts = run_starts(home, times)
        lengths = lengths_of(parts, len(home))
        self.size[slots[parts]] = lengths
        self.group[touched] = np.repeat(slots[parts], lengths)

    def order_groups(self) -> None:
        """Phase 2: the members of each group, smallest group first, by the suffix behind their Lyndon prefix.

        That suffix is smaller, hence in its place already, or it is a member too: then the Lyndon prefix repeats, and
        the member comes behind those whose prefix does so less often.
        """
        place = np.full(len(self.order), -1)
        marks = ragged(self.first, self.head)
        place[self.order[marks]] = marks
        at = self.first + self.head
        open_ = np.flatnonzero(at < self.last)
        while len(open_):
            begin = at[open_]
            sizes = self.size[begin]
            members = self.order[ragged(begin, sizes)]
            owner = np.repeat(np.arange(len(open_)), sizes)
            filled = begin.copy()
            while len(members):
                behind = place[self.end[members]]
                known = behind >= 0
                now = np.flatnonzero(known)
                now = now[np.argsort(behind[now], kind="stable")]  # slots of one set lie together, so sets stay together
                counts = np.bincount(owner[now], minlength=len(open_))
                slots = ragged(filled, counts)
                self.order[slots], place[members[now]] = members[now], slots
                filled += counts
                members, owner = members[~known], owner[~known]
            at[open_] = begin + sizes
            open_ = open_[at[open_] < self.last[open_]]
        self.slot = place


def suffix_order(strings: list[bytes], sets: np.ndarray) -> Suffixes:
    """The suffixes of every set in ascending order (``order``; end marks first)."""
    found = Suffixes.of(strings, sets)
    if len(strings):
        found.group_by_lyndon_prefix()
        found.order_groups()
    return found


def _classes_of(strings: list[bytes], sets: np.ndarray, width: int) -> np.ndarray:
    found = suffix_order(strings, sets)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    text = np.frombuffer(b"\0".join([*strings, bytes(width)]), np.uint8)
    starts = found.marks - sizes
    counts = np.maximum(sizes - width + 1, 0)
    window = np.zeros(len(found.order), bool)
    window[ragged(starts, counts)] = True
    sorted_ = found.order[window[found.order]]
    content = np.lib.stride_tricks.sliding_window_view(text, width)[sorted_]
    set_of = np.repeat(sets, sizes + 1)[sorted_]
    new = np.r_[True, (content[1:] != content[:-1]).any(axis=1) | (set_of[1:] != set_of[:-1])] if len(sorted_) else window[:0]
    of_position = np.zeros(len(found.order), np.int64)
    of_position[sorted_] = np.cumsum(new)
    return of_position[ragged(starts, counts)]


def window_classes(strings: list[bytes], sets: np.ndarray, width: int) -> np.ndarray:
    """For each ``width``-byte window of each string, in turn: its class; equal windows of one set share one.

    Suffixes that begin with the same window follow each other in suffix order. Sets of like size are ordered side by
    side, ``POSITIONS`` at a time.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    counts = np.maximum(sizes - width + 1, 0)
    out = np.empty(counts.sum(), np.int64)
    begins = np.cumsum(counts) - counts
    starts = run_starts(sets)
    members = lengths_of(starts, len(strings))
    weight = np.add.reduceat(sizes + 1, starts) if len(starts) else starts
    by_weight = np.argsort(weight, kind="stable")
    block = np.cumsum(weight[by_weight]) // POSITIONS
    used = 0
    for part in np.split(by_weight, run_starts(block)[1:]):
        if not len(part):
            continue
        part = np.sort(part)
        chosen = ragged(starts[part], members[part])
        classes = _classes_of([strings[i] for i in chosen.tolist()], sets[chosen], width)
        out[ragged(begins[chosen], counts[chosen])] = classes + used
        used += int(classes.max(initial=0)) + 1
    return out
