"""License scan: notice templates as token automata, mandatory wording exact.

Texts are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Base phrases (``PHRASES``) count wherever their words stand consecutively.

A template (``TEMPLATES``) is wording with two kinds of markup: ``[[ ... ]]`` may
be absent, ``{{n}}`` stands for any one to ``n`` words.  It is compiled into an
automaton over words whose states are positions in the wording; a text is
accepted from a word on if the automaton reaches its end, that is if all
mandatory words match exactly and in order.  The template's label then joins
the labels of the base phrases.  A document that lacks a mandatory word of
every template is not run through the automata.

Labels ending in ``-text`` are whole licence texts, conditions and disclaimer
included (MIT, ISC, BSD with two and three clauses); those in ``-notice`` are
sentences that name a licence, whole in themselves; those in ``-opening`` only the
first sentence of a licence text, whatever follows.  ``score`` is 1 if a whole text
or notice is found, else 0.75 for an opening, 0.5 for a base phrase, 0 for nothing.

Null text is empty.  Rows, also repeated ones, are scanned one by one; an empty
table gives an empty result; input columns named like a result column are
replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from kassa.llm import text as T

PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wording of the licence texts, words as in the texts.
_MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files [[the software]] to deal in the software without restriction"
)
_MIT_REST = (
    "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
    " copies of the software and to permit persons to whom the software is furnished to do so subject to the"
    " following conditions the above copyright notice and this permission notice [[including the next paragraph]]"
    " shall be included in all copies or substantial portions of the software the software is provided as is"
    " without warranty of any kind express or implied including but not limited to the warranties of"
    " merchantability fitness for a particular purpose and noninfringement in no event shall {{10}} be liable for"
    " any claim damages or other liability whether in an action of contract tort or otherwise arising from out of"
    " or in connection with the software or the use or other dealings in the software"
)
_ISC = (
    "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies the software"
    " is provided as is and {{8}} disclaims all warranties with regard to this software including all implied"
    " warranties of merchantability and fitness in no event shall {{8}} be liable for any special direct indirect or"
    " consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action"
    " of contract negligence or other tortious action arising out of or in connection with the use or performance of"
    " this software"
)
_BSD_GRANT = (
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met"
)
_BSD_TWO = (
    "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the"
    " following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list"
    " of conditions and the following disclaimer in the documentation and or other materials provided with the"
    " distribution"
)
_BSD_NAMES = (
    "[[3]] neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission"
)
_BSD_REST = (
    "this software is provided by {{12}} as is and any express or implied warranties including but not limited to the"
    " implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall"
    " {{12}} be liable for any direct indirect incidental special exemplary or consequential damages including but"
    " not limited to procurement of substitute goods or services loss of use data or profits or business"
    " interruption however caused and on any theory of liability whether in contract strict liability or tort"
    " including negligence or otherwise arising in any way out of the use of this software even if advised of the"
    " possibility of such damage"
)

#: Label and wording.
TEMPLATES = (
    ("mit-text", f"{_MIT_GRANT} {_MIT_REST}"),
    ("isc-text", _ISC),
    ("bsd-2-clause-text", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_REST}"),
    ("bsd-3-clause-text", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_NAMES} {_BSD_REST}"),
    ("mit-opening", _MIT_GRANT),
    ("bsd-opening", _BSD_GRANT),
    ("mit-notice", "[[this {{3}} is]] released under the mit license"),
    ("mit-notice", "licensed under the mit license"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 [[the license]]"),
    ("gpl-notice", "licensed under the [[terms of the]] gnu [[lesser]] general public license version {{1}}"),
    (
        "gpl-notice",
        "under the terms of the gnu [[lesser]] general public license as published by the free software foundation",
    ),
    ("cc-by-nc-notice", "licensed under [[a]] [[creative commons]] cc by nc 4 0"),
    ("cc-by-notice", "licensed under [[a]] creative commons attribution [[sharealike]] {{1}} 0 [[international]] license"),
    ("mpl-2.0-notice", "subject to the terms of the mozilla public license v 2 0"),
)

_RESULT = {
    "n_words": LongType(),
    "n_base": LongType(),
    "first_word": LongType(),
    "last_word": LongType(),
    "base_labels": StringType(),
    "labels": StringType(),
    "score": DoubleType(),
}


@dataclass
class Template:
    """``steps[i]``: (word or None for any, places to go on to); place -1: accepted."""

    label: str
    steps: list[tuple[bytes | None, tuple[int, ...]]]
    entry: tuple[int, ...]
    mandatory: frozenset[bytes]

    def accepts(self, words: list[bytes], at: int) -> bool:
        now = set(self.entry)
        for word in words[at:]:
            reached: set[int] = set()
            for place in now:
                wanted, onward = self.steps[place]
                if wanted is None or wanted == word:
                    reached.update(onward)
            if -1 in reached:
                return True
            if not reached:
                return False
            now = reached
        return False


def compile_template(label: str, wording: str) -> Template:
    """Automaton of a wording.  Optional regions do not nest."""
    parts: list[tuple[bytes | None, bool, int]] = []  # word, may be left out, optional region (0: none)
    region = regions = 0
    for piece in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", wording):
        if piece == "[[":
            regions += 1
            region = regions
        elif piece == "]]":
            region = 0
        elif piece.startswith("{{"):
            parts.extend((None, k > 0, region) for k in range(int(piece[2:-2])))
        else:
            parts.append((piece.encode(), False, region))

    def reachable(i: int) -> tuple[int, ...]:
        """Parts that may come next when part ``i`` is due; -1: the end."""
        out = []
        while True:
            if i == len(parts):
                return (*out, -1)
            _, loose, region = parts[i]
            out.append(i)
            if region and (i == 0 or parts[i - 1][2] != region):  # at its start a region can be passed over
                after = i
                while after < len(parts) and parts[after][2] == region:
                    after += 1
                out.extend(reachable(after))
                return tuple(dict.fromkeys(out))
            if not loose:
                return tuple(out)
            i += 1

    steps = [(word, reachable(i + 1)) for i, (word, _, _) in enumerate(parts)]
    mandatory = frozenset(word for word, _, region in parts if word is not None and not region)
    return Template(label, steps, reachable(0), mandatory)


@lru_cache(maxsize=4)
def _compiled(templates: tuple) -> list[Template]:
    return [compile_template(label, wording) for label, wording in templates]


def find_notices(words: list[bytes], templates: tuple = TEMPLATES) -> set[str]:
    """Labels of the templates that a text's words satisfy somewhere."""
    have = set(words)
    out = set()
    for template in _compiled(templates):
        if template.label in out or not template.mandatory <= have:
            continue
        starts = {template.steps[i][0] for i in template.entry}
        if any((None in starts or w in starts) and template.accepts(words, i) for i, w in enumerate(words)):
            out.add(template.label)
    return out


def score_of(phrases: set[str], notices: set[str]) -> float:
    if any(not label.endswith("-opening") for label in notices):
        return 1.0
    return 0.75 if notices else 0.5 if phrases else 0.0


def _hashes_of(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    raw = np.frombuffer(b"".join(words), np.uint8)
    return T.word_hashes(raw, np.append(0, ends[:-1]), ends)


def _scan(schema: pa.Schema, text_col: str, phrases: tuple, templates: tuple):
    def scan(batches):
        vocabulary = sorted({w for text, _ in phrases for w in text.encode().split()})
        codes = _hashes_of(vocabulary)
        # the rarest mandatory word is not known; the longest one serves as the key
        keys = _hashes_of([max(sorted(t.mandatory), key=len) for t in _compiled(templates)])
        wanted = np.unique(np.concatenate([codes, keys]))
        for block in T.blocks(batches, text_col):
            data = T.lower(block.data)
            first, last, bounds = T.word_spans(data, block.starts, block.ends, T.ALNUM)
            hashes = T.word_hashes(data, first, last)
            near = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            marked = np.append(0, np.cumsum(wanted[near] == hashes))
            n = len(block)
            n_base, begin, end = [0] * n, [None] * n, [None] * n
            base, labels, score = [""] * n, [""] * n, [0.0] * n
            for i in np.flatnonzero(marked[bounds[1:]] > marked[bounds[:-1]]).tolist():
                own = slice(bounds[i], bounds[i + 1])
                words = [data[a:b].tobytes() for a, b in zip(first[own], last[own], strict=True)]
                found = set()
                for text, label in phrases:
                    phrase = text.encode().split()
                    for at in range(len(words) - len(phrase) + 1):
                        if words[at] == phrase[0] and words[at : at + len(phrase)] == phrase:
                            found.add(label)
                            n_base[i] += 1
                            begin[i] = at if begin[i] is None else min(begin[i], at)
                            end[i] = at if end[i] is None else max(end[i], at)
                notices = find_notices(words, templates)
                base[i] = ",".join(sorted(found))
                labels[i] = ",".join(sorted(found | notices))
                score[i] = score_of(found, notices)
            extra = {
                "n_words": np.diff(bounds),
                "n_base": n_base,
                "first_word": begin,
                "last_word": end,
                "base_labels": base,
                "labels": labels,
                "score": score,
            }
            table = dict(zip(block.batch.schema.names, block.batch.columns, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(extra[f.name], f.type) if f.name in extra else table[f.name].cast(f.type) for f in schema],
                schema=schema,
            )

    return scan


def scan_licenses(
    docs: DataFrame, text_col: str = "text", phrases: tuple = PHRASES, templates: tuple = TEMPLATES
) -> DataFrame:
    """All columns of ``docs`` but the text, and those of ``_RESULT``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(*[c for c in docs.columns if c not in _RESULT])
    out = StructType([f for f in source.schema.fields if f.name != text_col])
    for name, kind in _RESULT.items():
        out = out.add(name, kind)
    return source.mapInArrow(_scan(to_arrow_schema(out), text_col, phrases, templates), out)
