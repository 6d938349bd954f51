"""License scans: normalised text against licence templates by the Dice coefficient over word bigrams.

Each line, each paragraph and each whole text is a unit. Text is lower-cased and all but letters and digits parts words.
The coefficient of a unit and a template is twice the bigrams they share over all bigrams of both, repeats counted.
It can only reach the threshold if the unit has between t / (2 - t) and (2 - t) / t times as many bigrams as the template,
so other templates are not looked at, and most units have no candidate at all. Units of a batch are
compared at once; words that are in no template are only counted. Thresholds are compared in whole numbers.

A notice may also stand inside a line or run over several. So all windows of words of an admissible size are units as well
(`span`). Those that start and end with a bigram of the template suffice, as any other would be better without its ends, and
t / (2 - t) times the template's bigrams must lie within the largest size, which leaves few places to look at. Of windows
that overlap, the best counts, then the first, then the shorter one.

Templates are a parameter, at most MAX_TEMPLATES of at most MAX_TEMPLATE_WORDS words, and travel with the code.
Null texts count as empty and match nothing, as does a unit of fewer than two words. Rows may repeat.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.llm.arrow_text import bound_batches, slices

THRESHOLD = 0.8
MAX_TEMPLATES = 1_000
MAX_TEMPLATE_WORDS = 20_000
SLICE_BYTES = 4 << 20
APART = r"[^\p{L}\p{N}]+"
#: Notices by which texts state their licence.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
    " compliance with the License.",
}


def normalised(text: pa.LargeStringArray) -> pa.LargeStringArray:
    """Words in lower case with single blanks between them."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(text), APART, " "), " ")


class Templates:
    """Bigram counts of all templates, by numbers."""

    def __init__(self, texts: Mapping[str, str]):
        self.names = sorted(texts)
        words = [normalised(pa.array([texts[name]], pa.large_string()))[0].as_py().split() for name in self.names]
        if len(words) > MAX_TEMPLATES or any(len(w) > MAX_TEMPLATE_WORDS for w in words):
            raise ValueError("too many or too long licence templates")
        self.vocabulary = pa.array(sorted({w for ws in words for w in ws}), pa.large_string())
        number = {w: i for i, w in enumerate(self.vocabulary.to_pylist())}
        self.counts = [Counter(number[a] * len(number) + number[b] for a, b in zip(ws, ws[1:], strict=False)) for ws in words]
        self.sizes = np.array([sum(c.values()) for c in self.counts])
        self.bigrams = np.array(sorted({b for c in self.counts for b in c}), np.int64)
        self.slots = [np.searchsorted(self.bigrams, np.array(sorted(c), np.int64)) for c in self.counts]
        self.own = [np.array([c[b] for b in sorted(c)], np.int64) for c in self.counts]

    def spans(self, codes: np.ndarray, starts: np.ndarray, threshold: float) -> list[tuple[int, int, int, float]]:
        """(text, first word in it, template, coefficient) of windows that reach the threshold; texts are runs of words."""
        if len(codes) < 2 or not len(self.bigrams):
            return []
        known = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
        owner = np.searchsorted(starts, known, "right") - 1
        inside = known + 1 < starts[owner + 1]
        known, owner = known[inside], owner[inside]
        key = codes[known] * len(self.vocabulary) + codes[known + 1]
        slot = np.minimum(np.searchsorted(self.bigrams, key), len(self.bigrams) - 1)
        same = self.bigrams[slot] == key
        known, owner, slot = known[same], owner[same], slot[same]
        share = Fraction(str(threshold))
        part, whole = share.numerator, share.denominator
        found = []
        for t, size in enumerate(self.sizes.tolist()):
            least, most = -(-part * size // (2 * whole - part)), (2 * whole - part) * size // part
            here = np.flatnonzero(np.isin(slot, self.slots[t])) if size else np.zeros(0, np.int64)
            if len(here) < max(least, 1):
                continue
            place, text, bigram = known[here], owner[here], np.searchsorted(self.slots[t], slot[here])
            last = np.arange(least - 1, len(place))
            dense = (place[last] - place[: len(last)] < most) & (text[last] == text[: len(last)])
            windows = []
            for i in np.flatnonzero(dense).tolist():
                end = min(np.searchsorted(place, place[i] + most), np.searchsorted(text, text[i], "right"))
                window = bigram[i:end]
                # A bigram counts as often as the template has it.
                order = np.argsort(window, kind="stable")
                heads = np.searchsorted(window[order], window[order])
                counted = np.zeros(len(window), np.int64)
                counted[order] = np.arange(len(window)) - heads < self.own[t][window[order]]
                shared, sizes = np.cumsum(counted), place[i:end] - place[i] + 1
                reached = 2 * shared * whole >= part * (sizes + size)
                if reached.any():
                    dice = np.where(reached, 2 * shared / (sizes + size), 0.0)
                    best = int(dice.argmax())
                    windows.append((-float(dice[best]), int(place[i]), int(place[i + best])))
            taken: list[tuple[int, int]] = []
            for dice, first, final in sorted(windows):
                after = bisect_left(taken, (first, first))
                free = (after == len(taken) or taken[after][0] > final) and (after == 0 or taken[after - 1][1] < first)
                if free:
                    insort(taken, (first, final))
                    of = int(np.searchsorted(starts, first, "right")) - 1
                    found.append((of, first - int(starts[of]), t, -dice))
        return found

    def matches(self, codes: np.ndarray, starts: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
        """(unit, template, coefficient) of all that reach the threshold; units are runs of words, -1 is any other word."""
        sizes = np.maximum(np.diff(starts) - 1, 0)
        share = Fraction(str(threshold))
        part, whole = share.numerator, share.denominator
        fits = [(sizes * (2 * whole - part) >= part * m) & (sizes * part <= (2 * whole - part) * m) & (m > 0) for m in self.sizes]
        any_fit = np.logical_or.reduce(fits) if fits else np.zeros(len(sizes), bool)
        chosen = np.flatnonzero(any_fit & (sizes > 0))
        if not len(chosen) or not len(self.bigrams):
            return []
        unit = np.repeat(chosen, sizes[chosen])
        offset = np.arange(len(unit)) - np.repeat(np.cumsum(sizes[chosen]) - sizes[chosen], sizes[chosen])
        first = codes[starts[unit] + offset]
        second = codes[starts[unit] + offset + 1]
        key = first * len(self.vocabulary) + second
        slot = np.minimum(np.searchsorted(self.bigrams, key), len(self.bigrams) - 1)
        known = (first >= 0) & (second >= 0) & (self.bigrams[slot] == key)
        pairs, n = np.unique(unit[known] * len(self.bigrams) + slot[known], return_counts=True)
        of_unit, bigram = pairs // len(self.bigrams), self.bigrams[pairs % len(self.bigrams)]
        found = []
        for t, counts in enumerate(self.counts):
            here = fits[t][of_unit]
            own = np.array([counts.get(b, 0) for b in bigram[here].tolist()], np.int64)
            shared = np.bincount(of_unit[here], np.minimum(n[here], own), len(sizes))
            for u in np.flatnonzero(shared):
                if 2 * int(shared[u]) * whole >= part * int(sizes[u] + self.sizes[t]):
                    found.append((int(u), t, float(2 * shared[u] / (sizes[u] + self.sizes[t]))))
        return found


def _units(text: pa.LargeStringArray) -> tuple[pa.LargeStringArray, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Words of a slice, and for each kind of unit where units start among them and the text of each."""
    lists = pc.split_pattern(text, "\n")
    owner, lines = pc.list_parent_indices(lists).to_numpy(), normalised(lists.flatten())
    words = pc.split_pattern(lines, " ")
    count = np.where(pc.equal(lines, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(words).to_numpy())
    flat = words.flatten()
    flat = flat.filter(pc.not_equal(flat, ""))
    ends = np.concatenate(([0], np.cumsum(count)))
    # A paragraph starts at each text and after each line without words.
    head = np.concatenate(([True], (owner[1:] != owner[:-1]) | (count[:-1] == 0))) if len(owner) else np.zeros(0, bool)
    heads = np.flatnonzero(head)
    first = np.searchsorted(owner, np.arange(len(text)))
    return flat, {
        "line": (ends, owner),
        "paragraph": (np.append(ends[heads], ends[-1]), owner[heads]),
        "text": (np.append(ends[first], ends[-1]), np.arange(len(text))),
    }


MATCH = "array<struct<license:string,dice:double,unit:string,number:int>>"


def found(text: Column, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """All matches of each text: licence, coefficient, kind of unit, and its number among the text's units from 0 (of a span,
    the number of its first word)."""
    table = Templates(templates)
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("unit", pa.string()), ("number", pa.int32())]))

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[list[dict]] = []
            for part in slices(batch, SLICE_BYTES):
                rows: list[list[dict]] = [[] for _ in range(len(part))]
                words, units = _units(part)
                codes = pc.fill_null(pc.index_in(words, value_set=table.vocabulary), -1).to_numpy().astype(np.int64)
                for name, (starts, owner) in units.items():
                    for unit, t, dice in table.matches(codes, starts, threshold):
                        number = unit - int(np.searchsorted(owner, owner[unit]))
                        rows[owner[unit]].append({"license": table.names[t], "dice": dice, "unit": name, "number": number})
                for text_number, word, t, dice in table.spans(codes, units["text"][0], threshold):
                    rows[text_number].append({"license": table.names[t], "dice": dice, "unit": "span", "number": word})
                out += rows
            yield pa.array(out, kind)

    bound_batches()
    return F.arrow_udf(compute, MATCH)(text)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: its id, all matches, and the licence of the best one (then the first by name), or null."""
    rows = docs.select(F.col(id_col), found(F.col(text_col), templates, threshold).alias("matches"))
    ranked = F.array_sort(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("rank"), m["license"].alias("license"))))
    best = F.element_at(ranked, 1)
    return rows.withColumn("best", F.when(F.size("matches") > 0, best)).select(
        id_col, F.col("best.license").alias("license"), (-F.col("best.rank")).alias("dice"), "matches"
    )
