"""The main text of an HTML page: blocks of prose, without tables, navigation and scripts.

Precision comes first: a block counts if it is long enough and few of its characters are links, and short
blocks only between such. Pages without one give NULL.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose content is never article text, and those that end a block.
SKIPPED = frozenset("script style noscript template svg nav header footer aside form button select table iframe figure head".split())
BLOCKS = frozenset("p div section article main h1 h2 h3 h4 h5 h6 li ul ol blockquote pre br hr td tr body".split())
VOID = frozenset("br hr img input meta link source wbr area base col embed param track".split())
#: Characters from which a block is prose, and the share of link characters up to which.
PROSE, LINKS = 60, 0.3


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, float, bool]] = []
        self.skip: list[str] = []
        self.parts: list[str] = []
        self.linked, self.depth, self.inside = 0, 0, 0

    def close_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.linked / len(text), self.inside > 0))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.close_block()
        if tag in VOID:
            return
        if tag in SKIPPED or self.skip:
            # Only elements of the skipped kind are counted: others inside may never be closed.
            if tag in SKIPPED:
                self.close_block()
                self.skip.append(tag)
            return
        self.depth += tag == "a"
        self.inside += tag in ("article", "main")

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if tag in BLOCKS:
            self.close_block()
        if tag == "a":
            self.depth = max(0, self.depth - 1)
        if tag in ("article", "main"):
            self.inside = max(0, self.inside - 1)

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.parts.append(data)
            if self.depth:
                self.linked += len("".join(data.split()))


def main_text(page: bytes | str | None) -> str | None:
    """The article of one page as one line; NULL for null, empty and textless pages."""
    if not page:
        return None
    reader = _Blocks()
    reader.feed(page if isinstance(page, str) else bytes(page).decode("utf-8", "replace"))
    reader.close()
    reader.close_block()
    blocks = reader.blocks
    if any(inside and len(t) >= PROSE for t, _, inside in blocks):
        blocks = [b for b in blocks if b[2]]
    good = [i for i, (t, share, _) in enumerate(blocks) if len(t) >= PROSE and share <= LINKS]
    if not good:
        return None
    # Headings and short lines between prose belong to it.
    kept = [t for t, share, _ in blocks[good[0] : good[-1] + 1] if share <= LINKS]
    return " ".join(kept)


def article_text(page: str | Column) -> Column:
    """:func:`main_text` of a binary or text column, in Arrow batches."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return run(F.col(page) if isinstance(page, str) else page)
