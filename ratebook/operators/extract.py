"""Table extraction from HTML pages.

Split of work:

* Python (``mapInPandas``, Arrow batches, stdlib ``html.parser``; no lxml or
  bs4 in the image) only turns each page into its tables' cell grids, one
  output row per page with its source and error. A page is one document, so
  the work per task is bounded by the page size.
* Spark does the rest inside that row with built-in array expressions: table
  scoring and choice (E2/E9), header cleaning (E3/E4), blank rows (E6), audit
  text (E7) and the strategy chain (E10); the chosen table's rows are then
  exploded once into maps (E5) with their lineage (E8). Nothing is shuffled.

Strategy 1 follows the ``read_html`` reading of tables (header = ``<thead>``
rows, else leading all-``<th>`` rows; colspan/rowspan expanded; empty cells
are missing values). Strategy 2 is the fallback reading (all ``<table>``
elements, else ``<div>`` whose class matches ``table|rate|schedule``; the
container with most ``<tr>``; header = first row of the first ``<thead>``,
else the first row; cell text = stripped text pieces joined).
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.fixed import BLANK_HEADER, DIV_CLASS_PATTERN, RAW_TEXT_SEPARATOR, TABLE_KEYWORDS
from ratebook.functions.fmt import render
from ratebook.functions.text import snake

# Python-worker code of this module travels with the task (pickled by value),
# so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(__import__("sys").modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference pickling
    pass

_GRID = "array<struct<table_idx:int,n_tr:int,head:array<array<string>>,body:array<array<string>>>>"

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_SKIP_TEXT = {"script", "style", "template"}
_SECTIONS = {"thead", "tbody", "tfoot"}
# A start tag that ends an open one of its kind, and what it doesn't reach out of.
_CLOSES_ITSELF = {"p": {"td", "th", "table", "div", "section", "article"}, "li": {"ul", "ol"}, "option": {"select"}}
# Bounds of the HTML standard.
_MAX_COLSPAN, _MAX_ROWSPAN = 1_000, 65_534


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def _walk(self, into):
        """Everything below, in document order, whatever the depth."""
        stack = self.children[::-1]
        while stack:
            c = stack.pop()
            yield c
            if isinstance(c, _Node) and into(c):
                stack += c.children[::-1]

    def iter(self, tag=None):
        for c in self._walk(lambda n: True):
            if isinstance(c, _Node) and (tag is None or c.tag in tag):
                yield c

    def kids(self, tags):
        return [c for c in self.children if isinstance(c, _Node) and c.tag in tags]

    def strings(self):
        for c in self._walk(lambda n: n.tag not in _SKIP_TEXT):
            if isinstance(c, str):
                yield c


class _Builder(HTMLParser):
    """Minimal tree builder with the implicit closes tables need."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def _close_until(self, tags, stop):
        n = self.cur
        while n is not self.root and n.tag not in stop:
            if n.tag in tags:
                self.cur = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("td", "th"):
            self._close_until({"td", "th"}, {"tr", "table"})
        elif tag == "tr":
            self._close_until({"tr"}, {"table"})
        elif tag in _SECTIONS:
            self._close_until(_SECTIONS, {"table"})
        elif tag in _CLOSES_ITSELF:
            self._close_until({tag}, _CLOSES_ITSELF[tag])
        node = _Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, dict(attrs), self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not self.root:
            if n.tag == tag:
                self.cur = n.parent
                return
            n = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def _parse(html: str) -> _Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_WS2 = re.compile(r"[\r\n]+|\s{2,}")


def _cell_text_1(td: _Node) -> str:
    return _WS2.sub(" ", "".join(td.strings()).strip())


def _cell_text_2(td: _Node) -> str:
    return "".join(s.strip() for s in td.strings() if s.strip())


def _expand(rows: list[_Node]) -> list[list[tuple[str, bool]]]:
    """colspan / rowspan expansion of one section; cells are (text, is_th).
    A rowspan past the last row adds rows of what it still spans."""
    out: list[list[tuple[str, bool]]] = []
    pending: dict[int, tuple[str, bool, int]] = {}
    for tr in rows:
        row: list[tuple[str, bool]] = []
        col = 0
        cells = tr.kids({"td", "th"})
        ci = 0
        while ci < len(cells) or col in pending:
            if col in pending:
                text, th, left = pending.pop(col)
                row.append((text, th))
                if left > 1:
                    pending[col] = (text, th, left - 1)
                col += 1
                continue
            td = cells[ci]
            ci += 1
            text, th = _cell_text_1(td), td.tag == "th"
            try:
                cs = min(_MAX_COLSPAN, max(1, int(td.attrs.get("colspan", 1) or 1)))
                rs = min(_MAX_ROWSPAN, max(1, int(td.attrs.get("rowspan", 1) or 1)))
            except ValueError:
                cs, rs = 1, 1
            for _ in range(cs):
                row.append((text, th))
                if rs > 1:
                    pending[col] = (text, th, rs - 1)
                col += 1
        out.append(row)
    while pending:
        out.append([pending[c][:2] for c in sorted(pending)])
        pending = {c: (t, th, left - 1) for c, (t, th, left) in pending.items() if left > 1}
    return out


def _strategy1(root: _Node):
    """Every <table>: header rows then body rows (pandas-like reading)."""
    for ti, table in enumerate(root.iter({"table"})):
        head = [tr for s in table.kids({"thead"}) for tr in s.kids({"tr"})]
        body = [tr for s in table.kids({"tbody"}) for tr in s.kids({"tr"})] + table.kids({"tr"})
        foot = [tr for s in table.kids({"tfoot"}) for tr in s.kids({"tr"})]
        n_tr = len(head) + len(body) + len(foot)
        if not head:
            while body and body[0].kids({"td", "th"}) and not body[0].kids({"td"}):
                head.append(body.pop(0))
        hrows, brows = _expand(head), _expand(body) + _expand(foot)
        yield {"table_idx": ti, "n_tr": n_tr, "head": [[t for t, _ in r] for r in hrows],
               "body": [[t for t, _ in r] for r in brows]}


def _strategy2(root: _Node):
    """Fallback: all tables, else class-matched divs; every container is
    emitted with its <tr> count, Spark keeps the one with most rows."""
    containers = list(root.iter({"table"}))
    if not containers:
        pat = re.compile(DIV_CLASS_PATTERN, re.I)
        containers = [d for d in root.iter({"div"})
                      if any(pat.search(c) for c in (d.attrs.get("class") or "").split())]
    for ti, t in enumerate(containers):
        trs = list(t.iter({"tr"}))
        if not trs:
            continue
        theads = list(t.iter({"thead"}))
        header = None
        if theads:
            first = next(theads[0].iter({"tr"}), None)
            header = first
        if header is None and not theads:
            header = trs[0]
        hcells = [_cell_text_2(c) for c in header.iter({"td", "th"})] if header is not None else []
        if theads:
            tb = t.kids({"tbody"})
            data = list(tb[0].iter({"tr"})) if tb else trs[1:]
        else:
            data = trs[1:]
        yield {"table_idx": ti, "n_tr": len(trs), "head": [hcells],
               "body": [[_cell_text_2(c) for c in tr.iter({"td", "th"})] for tr in data]}


def _parsed(html, first: bool) -> tuple[str | None, list, list]:
    """(error, tables by the first strategy, containers by the fallback)."""
    if html is None or not str(html).strip():
        return "Empty HTML content", [], []
    try:
        root = _parse(str(html))
        return None, list(_strategy1(root)) if first else [], list(_strategy2(root))
    except Exception as e:  # noqa: BLE001 - recorded per page, as a parse error
        return f"{type(e).__name__}: {e}", [], []


def parse_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", has_selector: bool = True,
                source_col: str | None = None) -> DataFrame:
    """E1 (+ the container census of E9): one row per page: page_id,
    source_name, error, first and fallback (arrays of tables). With a table
    selector configured only the fallback is made (see :func:`extract`)."""
    source = F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), source.alias("source_name"),
                       F.col(html_col).cast("string").alias("html"))

    def batches(it):
        for pdf in it:
            got = [_parsed(h, not has_selector) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "source_name": pdf["source_name"],
                                "error": pd.Series([g[0] for g in got], dtype=object),
                                "first": [g[1] for g in got], "fallback": [g[2] for g in got]})

    return src.mapInPandas(batches, f"page_id long, source_name string, error string, first {_GRID}, fallback {_GRID}")


def clean_headers(cells: Column) -> Column:
    """E3 + E4: snake_case each header; blank -> col_<position>."""
    return F.transform(cells, lambda x, i: F.coalesce(F.nullif(snake(x), F.lit("")),
                                                      render(BLANK_HEADER, i=i.cast("string"))))


def distinct_headers(cells: Column) -> Column:
    """A header that stood before gets '.1', '.2'... behind it; blanks stay."""
    def named(x: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(cells, F.lit(1), i), lambda y: y == x))
        return F.when((x != "") & (before > 0), F.concat(x, F.lit("."), before.cast("string"))).otherwise(x)
    return F.transform(cells, named)


def _keyword_score(text: Column, keywords=TABLE_KEYWORDS) -> Column:
    s = None
    for k in keywords:
        term = F.when(text.contains(k), 1).otherwise(0)
        s = term if s is None else s + term
    return s


def _greatest_size(rows: Column) -> Column:
    return F.aggregate(rows, F.lit(0), lambda w, r: F.greatest(w, F.size(r)))


def _positions(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def pick_best_table(tables: Column) -> Column:
    """E2 (strategy 1): among tables with >= 2 data rows the best by (keyword
    score desc, data rows desc, first table); none qualifies -> the table
    with most data rows (first on ties)."""
    def ranked(t: Column) -> Column:
        width = F.when(F.size(t["head"]) > 0, _greatest_size(t["head"])).otherwise(_greatest_size(t["body"]))
        hdr = F.array_join(F.transform(t["head"], lambda r: F.lower(F.array_join(r, " "))), " ")
        # Without a header row the column names are the positions 0..w-1.
        hdr = F.when(hdr != "", hdr).otherwise(F.array_join(F.transform(_positions(width), lambda x: x.cast("string")), " "))
        sample = F.array_join(F.transform(F.slice(t["body"], 1, 3), lambda r: F.lower(
            F.array_join(F.filter(r, lambda x: x != ""), " "))), " ")
        n = F.size(t["body"])
        score = F.when(n >= 2, _keyword_score(F.concat_ws(" ", hdr, sample)))
        return F.struct(score.isNotNull().alias("q"), F.coalesce(score, F.lit(-1)).alias("s"), n.alias("n"),
                        (-t["table_idx"]).alias("i"), t.alias("t"))
    return F.array_max(F.transform(tables, ranked))["t"]


def pick_best_container(tables: Column) -> Column:
    """The container with most <tr> (first on ties)."""
    return F.array_max(F.transform(tables, lambda t: F.struct(t["n_tr"].alias("n"), (-t["table_idx"]).alias("i"),
                                                              t.alias("t"))))["t"]


def _row(i: Column, names: Column, vals: Column, raw: Column) -> Column:
    return F.struct(i.cast("int").alias("row_idx"), names.alias("names"), vals.alias("vals"), raw.alias("raw_text"))


def _rows_first(t: Column) -> Column:
    """Data rows of a table by strategy 1. Several header rows: one name per
    column, the rows' texts joined by ' '; missing and empty cells are missing
    values; all-missing rows are dropped."""
    hw, bw = _greatest_size(t["head"]), _greatest_size(t["body"])
    joined = F.transform(_positions(hw), lambda i: F.array_join(F.transform(t["head"], lambda r: F.get(r, i)), " "))
    names = F.when(F.size(t["head"]) > 0, clean_headers(distinct_headers(joined))).otherwise(
        F.transform(_positions(bw), lambda x: x.cast("string")))

    def shaped(r: Column, i: Column) -> Column:
        vals = F.transform(names, lambda n, k: F.nullif(F.get(r, k), F.lit("")))
        return _row(i, names, vals, F.array_join(F.filter(vals, lambda v: v.isNotNull()), RAW_TEXT_SEPARATOR))
    return F.filter(F.transform(t["body"], shaped), lambda r: F.exists(r["vals"], lambda v: v.isNotNull()))


def _rows_fallback(t: Column) -> Column:
    """Data rows by the fallback: short rows padded with '', long rows cut."""
    names = clean_headers(F.element_at(t["head"], -1))

    def shaped(r: Column, i: Column) -> Column:
        vals = F.transform(names, lambda n, k: F.coalesce(F.get(r, k), F.lit("")))
        return _row(i, names, vals, F.array_join(F.filter(r, lambda v: v != ""), RAW_TEXT_SEPARATOR))
    cells = F.transform(t["body"], lambda r, i: F.struct(r.alias("r"), i.alias("i")))
    return F.transform(F.filter(cells, lambda x: F.size(x["r"]) > 0), lambda x: shaped(x["r"], x["i"]))


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Computed columns that later expressions read and never recompute (the
    optimiser moves nothing through a generator)."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def raw_rows(parsed: DataFrame) -> DataFrame:
    """E2-E10 on :func:`parse_pages` rows; see :func:`extract`."""
    _last_value_wins(parsed)
    best = _once(parsed.where("error is null").select("page_id", "source_name", "first", "fallback"),
                 one=pick_best_table(F.col("first")), two=pick_best_container(F.col("fallback")))
    best = best.select("page_id", "source_name", "one", "two")
    none = F.array().cast("array<struct<row_idx:int,names:array<string>,vals:array<string>,raw_text:string>>")
    made = _once(best, rows1=F.coalesce(F.when(F.col("one").isNotNull(), _rows_first(F.col("one"))), none),
                 rows2=F.coalesce(F.when(F.col("two").isNotNull(), _rows_fallback(F.col("two"))), none))
    strategy = F.when(F.size("rows1") > 0, 1).otherwise(2)
    chosen = made.select("page_id", "source_name", strategy.alias("strategy"),
                         F.when(strategy == 1, F.col("one.table_idx")).otherwise(F.col("two.table_idx")).alias("table_idx"),
                         F.explode(F.when(strategy == 1, F.col("rows1")).otherwise(F.col("rows2"))).alias("r"))
    rows = chosen.select("page_id", "table_idx", F.col("r.row_idx").alias("row_idx"), "strategy",
                         F.map_from_arrays("r.names", "r.vals").alias("cells"), F.col("r.raw_text").alias("raw_text"),
                         "source_name")
    return rows.withColumn("ord", F.struct("page_id", "table_idx", "row_idx"))


def page_errors(parsed: DataFrame) -> DataFrame:
    """Pages of :func:`parse_pages` whose content was empty or unreadable."""
    return parsed.where("error is not null").select("page_id", "error")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
            has_selector: bool = True, source_col: str | None = None) -> DataFrame:
    """Per page the first strategy that yields rows. With a table
    selector configured the first strategy never runs (it fails on that
    configuration), so only the fallback applies — the default, as in the
    shipped configuration. Returns RAW rows: page_id, table_idx, row_idx,
    strategy, cells MAP, raw_text, source_name, ord. For the errors beside the
    rows write :func:`parse_pages` once and read both from it."""
    return raw_rows(parse_pages(pages, id_col, html_col, has_selector, source_col))


def _last_value_wins(df: DataFrame) -> None:
    """Rows become maps keyed by header: a repeated header keeps its last
    value (at its first position), which is Spark's LAST_WIN dedup policy."""
    df.sparkSession.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def extract_errors(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Pages whose content is empty or could not be parsed (error per page)."""
    return page_errors(parse_pages(pages, id_col, html_col))


def grid_to_rows(grid: DataFrame, header_first: bool = True, keys: tuple[str, ...] = ("page_id",),
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """E4-E7 on cell grids (``keys``, row_idx, cells) such as PDF tables, one
    grid per value of ``keys``: row 0 = header; grids with < 2 rows and
    all-empty rows are dropped; short rows padded, long rows cut; duplicate
    headers: last wins; the raw text is that of the cells kept. ``carry``
    columns come along."""
    _last_value_wins(grid)
    keys = list(keys)
    sizes = grid.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    g = grid.join(sizes, keys).filter(F.col("__n") >= 2)
    hdr = g.filter(F.col("row_idx") == 0).select(*keys, clean_headers(
        F.transform("cells", lambda x: F.coalesce(x, F.lit("")))).alias("__h"))
    body = g.filter(F.col("row_idx") > 0).join(hdr, keys)
    cells = F.transform("cells", lambda x: F.trim(F.coalesce(x, F.lit(""))))
    w = F.size("__h")
    n = F.size(cells)
    vals = F.when(n >= w, F.slice(cells, 1, w)).otherwise(F.concat(cells, F.array_repeat(F.lit(""), w - n)))
    body = body.withColumn("__c", cells).filter(F.exists("__c", lambda x: x != ""))
    return body.select(*keys, "row_idx", F.map_from_arrays("__h", vals).alias("cells"),
                       F.array_join(F.filter(F.slice("__c", F.lit(1), w), lambda x: x != ""), RAW_TEXT_SEPARATOR).alias("raw_text"),
                       *carry)


def document_rows(grid: DataFrame) -> DataFrame:
    """E4-E8 on the tables of paged documents: (doc_id, page, table_idx,
    row_idx, cells, source_name) with 1-based pages and any number of tables on
    a page -> RAW rows whose cells carry the lineage keys ``_raw_text``,
    ``_source_name`` and ``_page``, in document order."""
    rows = grid_to_rows(grid, keys=("doc_id", "page", "table_idx"), carry=("source_name",))
    lineage = F.create_map(F.lit("_raw_text"), F.col("raw_text"), F.lit("_source_name"), F.coalesce("source_name", F.lit("")),
                           F.lit("_page"), F.col("page").cast("string"))
    return rows.select("doc_id", "page", "table_idx", "row_idx", F.map_concat("cells", lineage).alias("cells"), "raw_text",
                       "source_name", F.struct("doc_id", "page", "table_idx", "row_idx").alias("ord"))
