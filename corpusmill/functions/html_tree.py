"""B3 nested form: a small per-row HTML block reader on the stdlib parser.

Tree rules (the working definition, stated by the goldens):
- every ``p``/``h1``-``h6`` start tag opens a block, in document order;
- an end tag closes the nearest open element of that name and everything
  opened after it; with no such element it is ignored; unclosed elements end
  with the document, so an unclosed paragraph contains the following ones;
- void elements never open;
- text inside script/style/template, ruby readings (rt, rp) and comments is not text;
- a text run between two markup events that is only ASCII whitespace counts
  as one newline (if it has one) or one space, outside pre/textarea.
A block's text is all text inside it, joined without separator.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

# Fixed values.
BLOCK_TAGS = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
VOID_TAGS = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
    "command", "frame", "image", "isindex", "nextid", "spacer"))
HIDDEN_TAGS = frozenset(("script", "style", "template", "rt", "rp"))
PRESERVE_TAGS = frozenset(("pre", "textarea"))
ASCII_SPACES = " \n\t\f\r"


class _BlockReader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.size = 0
        self.pending: list[str] = []
        self.stack: list[tuple[str, int]] = []   # (tag, block index or -1)
        self.blocks: list[list] = []             # [tag, start, end]
        self.hidden = 0
        self.preserve = 0

    def _flush(self) -> None:
        if not self.pending:
            return
        s = "".join(self.pending)
        self.pending = []
        if not s or self.hidden:
            return
        if not self.preserve and s.strip(ASCII_SPACES) == "":
            s = "\n" if "\n" in s else " "
        self.text.append(s)
        self.size += len(s)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in VOID_TAGS:
            return
        idx = -1
        if tag in BLOCK_TAGS:
            idx = len(self.blocks)
            self.blocks.append([tag, self.size, None])
        self.stack.append((tag, idx))
        self.hidden += tag in HIDDEN_TAGS
        self.preserve += tag in PRESERVE_TAGS

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                break
        else:
            return
        while len(self.stack) > i:
            name, idx = self.stack.pop()
            if idx >= 0:
                self.blocks[idx][2] = self.size
            self.hidden -= name in HIDDEN_TAGS
            self.preserve -= name in PRESERVE_TAGS

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA[") and not self.hidden:
            self.text.append(data[6:])
            self.size += len(data) - 6


def iter_blocks(html: str | None) -> Iterator[tuple[str, str]]:
    """(tag, raw text) of every block in document order, one at a time.

    Unclosed blocks hold all that follows, so their texts together can be far
    longer than the page; the caller decides how many it holds.
    """
    if html is None:
        return
    reader = _BlockReader()
    reader.feed(html)
    reader.close()
    reader._flush()
    text = "".join(reader.text)
    for tag, start, end in reader.blocks:
        yield tag, text[start:(reader.size if end is None else end)]


def read_blocks(html: str | None) -> list[tuple[str, str]]:
    """All blocks of a page."""
    return list(iter_blocks(html))
