"""Main text of web pages: the maximum-scoring run of words and tags.

A page is a sequence of tokens: words, and tags by element name and class names.
Words score positive and tags negative, by weights learned from labelled pages: a
page with one ``<article>`` element is labelled by it.  A word's weight is the
share of labelled words inside under the same enclosing element; a tag's weight
is the logarithm of that share for its kind, minus a little.  What ``BOILERPLATE``
elements and classes enclose has no words and lightly negative tags, so an advert
inside an article does not split it.  One linear scan (Kadane's) finds the
contiguous region with the best sum.

From the region come the blocks, cut at block-level tags.  Character references are decoded,
white space in a block becomes one space, blocks are joined by an empty line.

The weights come from at most ``MAX_PAGES`` labelled pages of at most
``MAX_PAGE_BYTES`` each, chosen by a hash of page_id: the sample's bound in bytes also
bounds the counts of token kinds, of which all are kept.  Without such pages, only the fixed lists speak.  Null html is an empty page;
an unfinished tag at the end is dropped; an element that is never closed ends
with the one around it.  Rows, also repeated ones, are extracted one by one; an
empty table gives an empty result; input columns named ``text`` or ``n_chars``
are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from kassa.llm import text as T

MAX_PAGES = 2000
MAX_PAGE_BYTES = 128 << 10

# Element names of HTML by their role.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "title", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSED_BY_SIBLING = {
    "li": frozenset(["li"]),
    "p": frozenset(["p"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
BOILERPLATE = frozenset(
    "nav menu header footer aside form script style noscript template iframe svg button select option textarea"
    " input dialog canvas object".split()
)
BOILERPLATE_CLASSES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer"
    " header menu nav navbar navigation newsletter notice popup promo related respond reviews share sharing sidebar"
    " social sponsor sponsored subscribe toolbar widget".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?![^\s/>])(?P<rawattr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*\Z|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_CLASS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Token:
    kind: str  # word scope or tag kind
    text: str | None = None  # words
    n_words: int = 0
    breaks: bool = False  # a block ends here
    skipped: bool = False  # inside boilerplate
    article: int = 0  # +1 an article opens, -1 closes


def _names(attributes: str) -> tuple[list[str], str | None]:
    names, role = [], None
    for key, a, b, c in _CLASS.findall(attributes):
        value = (a or b or c).lower()
        if key.lower() == "role":
            role = value
        else:
            names.extend(value.split())
    return names, role


def _is_boilerplate(name: str, names: list[str], role: str | None) -> bool:
    if name in BOILERPLATE or role in BOILERPLATE_ROLES:
        return True
    parts = {p for n in names for p in (n, *re.split(r"[-_]", n))}
    return not parts.isdisjoint(BOILERPLATE_CLASSES)


def tokens(source: str) -> list[Token]:
    """Words and tags of a page, in order."""
    out: list[Token] = []
    stack: list[tuple[str, str, bool]] = []  # name, kind, boilerplate
    opened: Counter[str] = Counter()  # names in the stack, so that no search is in vain

    def close(at: int) -> None:
        while len(stack) > at:
            name, kind, hidden = stack.pop()
            opened[name] -= 1
            article = -1 if name == "article" else 0
            out.append(Token("/" + kind, breaks=name in BLOCKS, skipped=hidden, article=article))

    for match in _TOKEN.finditer(source):
        text = match["text"]
        if text is not None:
            scope = stack[-1][1] if stack else ""
            out.append(
                Token("word " + scope, text, len(text.split()), skipped=bool(stack) and stack[-1][2])
            )
            continue
        if match["raw"]:
            out.append(Token(match["raw"].lower(), breaks=match["raw"].lower() in BLOCKS, skipped=True))
            continue
        if not match["name"]:
            continue  # comment, declaration, unfinished tag
        name = match["name"].lower()
        if match["end"]:
            at = -1
            if opened[name]:
                at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
            if at >= 0:
                close(at)
            elif name in BLOCKS or name == "br":
                out.append(Token("/" + name, breaks=name in BLOCKS, skipped=bool(stack) and stack[-1][2]))
            continue
        if name in CLOSED_BY_SIBLING or name in BLOCKS:
            siblings = CLOSED_BY_SIBLING.get(name, frozenset()) | (frozenset(["p"]) if name in BLOCKS else frozenset())
            for i in range(len(stack) - 1, -1, -1) if any(opened[x] for x in siblings) else ():
                if stack[i][0] in siblings:
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        names, role = _names(match["attr"])
        kind = ".".join([name, *sorted(set(names))])
        hidden = (bool(stack) and stack[-1][2]) or _is_boilerplate(name, names, role)
        article = 1 if name == "article" else 0
        out.append(Token(kind, breaks=name in BLOCKS, skipped=hidden, article=article))
        if name == "br":
            out[-1].text = " "
        if name not in VOID and not match["attr"].rstrip().endswith("/"):
            opened[name] += 1
            stack.append((name, kind, hidden))
    close(0)
    return out


class Weights:
    """Learned from counts of each kind of token inside and outside of articles."""

    TAG_SCALE = 8.0
    UNKNOWN_WORD = 0.8
    UNKNOWN_TAG = 0.95
    SKIPPED_TAG = -0.5

    def __init__(self, inside: Counter, outside: Counter):
        self.inside, self.outside = inside, outside
        # a tag kind never seen outside or inside: as its element, without classes
        self.known = {k: self._share(k) for k in {*inside, *outside}}

    def _share(self, kind: str) -> float:
        i, o = self.inside[kind], self.outside[kind]
        return (i + 0.5) / (i + o + 1)

    def _find(self, kind: str, fallback: float) -> float:
        if kind in self.known:
            return self.known[kind]
        plain = kind.split(".")[0]
        return self.known.get(plain, fallback)

    def of(self, token: Token) -> float:
        if token.kind.startswith("word "):
            return 0.0 if token.skipped else token.n_words * self._find(token.kind, self.UNKNOWN_WORD)
        if token.skipped:
            return self.SKIPPED_TAG
        share = self._find(token.kind, self.UNKNOWN_TAG)
        if token.article:
            share = 0.0005  # the label itself lies outside of what it encloses
        return self.TAG_SCALE * math.log(share) - 0.01


def learn(pages) -> tuple[Counter, Counter]:
    """Counts of token kinds inside and outside of the one article of each page."""
    inside, outside = Counter(), Counter()
    for page in pages:
        found = tokens(page or "")
        if sum(t.article == 1 for t in found) != 1:
            continue
        depth = 0
        for t in found:
            if t.article:
                depth += t.article
                continue
            if t.skipped:
                continue
            side = inside if depth > 0 else outside
            side[t.kind] += t.n_words if t.kind.startswith("word ") else 1
    return inside, outside


def best_region(found: list[Token], weights: Weights) -> tuple[int, int]:
    """Bounds of the contiguous tokens with the largest sum; the first such."""
    best = total = 0.0
    region, start = (0, 0), 0
    for i, token in enumerate(found):
        total += weights.of(token)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(source: str | None, weights: Weights) -> str:
    found = tokens(source or "")
    a, b = best_region(found, weights)
    blocks, now = [], []
    for token in found[a:b]:
        if token.breaks:
            blocks.append(now)
            now = []
        elif token.text is not None and not token.skipped:
            now.append(token.text)
    blocks.append(now)
    texts = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks)
    return "\n\n".join(t for t in texts if t)


def fit(
    pages: DataFrame,
    max_pages: int = MAX_PAGES,
    id_col: str = "page_id",
    html_col: str = "html",
    max_page_bytes: int = MAX_PAGE_BYTES,
) -> Weights:
    """Weights from a sample of labelled pages, bounded in rows and bytes."""
    sample = (
        pages.where(F.col(html_col).contains("<article") & (F.octet_length(html_col) <= max_page_bytes))
        .select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
        .withColumn("rank", F.xxhash64("id"))
        .withColumn("digest", F.xxhash64("html"))
    )
    # pages are picked by id and digest, as an id may have many pages; then only they are read whole
    picked = sample.select("rank", "id", "digest").distinct().orderBy("rank", "id", "digest").limit(max_pages)
    rows = sample.join(F.broadcast(picked.select("id", "digest")), ["id", "digest"]).select("html").distinct()

    def count(batches):
        for batch in batches:
            inside, outside = learn(batch.column(0).to_pylist())
            kinds = sorted({*inside, *outside})
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), *(pa.array([c[k] for k in kinds], pa.int64()) for c in (inside, outside))],
                names=["kind", "inside", "outside"],
            )

    counts = (
        rows.mapInArrow(count, "kind string, inside long, outside long")
        .groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()
    )
    return Weights(Counter({r.kind: r.inside for r in counts}), Counter({r.kind: r.outside for r in counts}))


def extract(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, then text (string) and n_chars (long)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    held = pages.sparkSession.sparkContext.broadcast((weights.inside, weights.outside))
    source = pages.select(*[c for c in pages.columns if c not in ("text", "n_chars")])
    out = StructType([f for f in source.schema.fields if f.name != html_col])
    out = out.add("text", StringType()).add("n_chars", LongType())
    schema = to_arrow_schema(out)

    def run(batches):
        own = Weights(*held.value)
        for block in T.blocks(batches, html_col):
            texts = [main_text(block.text(i).decode("utf-8", "replace"), own) for i in range(len(block))]
            extra = {"text": texts, "n_chars": [len(t) for t in texts]}
            table = dict(zip(block.batch.schema.names, block.batch.columns, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(extra[f.name], f.type) if f.name in extra else table[f.name].cast(f.type) for f in schema],
                schema=schema,
            )

    return source.mapInArrow(run, out)
