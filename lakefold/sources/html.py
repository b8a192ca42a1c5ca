"""The first ``<table>`` of an HTML page as rows, with native regular expressions.

The first table's rows are split on ``<tr>``, cells on ``<th>``/``<td>``, inner markup
is removed, entities are decoded and cell text is trimmed (an empty cell is NULL).
A cell that spans columns or rows is repeated in each of them: columns by repetition,
rows by a fold that carries what still hangs down into the next row, only for pages
that have such cells.  Comments are removed first.  The first row is the heading if all
its cells are ``<th>``; more such rows right below it are not data either, but a later
row that starts with a ``<th>`` is.  Headings are renamed by a map and every mapped
heading must be present.  Nested tables are outside this contract.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.functions.text import strip_ws

_TABLE = r"(?is)<table\b.*?</table>"
_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
_CELL = r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"
_COMMENT = r"(?s)<!--.*?-->"
_MARKUP = r"(?s)<[^>]*>"
_HEAD_CELL = r"(?is)<th\b"
_DATA_CELL = r"(?is)<td\b"

_ENTITY = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&"
_SPAN = r"(?i)^<[^>]*\s%s\s*=\s*[\"']?\s*([0-9]{1,9})"
_MOST = {"colspan": 1000, "rowspan": 65534}  # of the HTML standard

# Cells that hang down from rows above: column, text and rows left.
_HANGING = "array<struct<col:int,text:string,left:int>>"


def _named() -> Column:
    """Named entities and their characters (a no-break space is a blank here)."""
    names = {f"&{k}": v for k, v in html5.items() if k.endswith(";")}
    return F.from_json(F.lit(json.dumps({**names, "&nbsp;": " "})), "map<string,string>")  # a constant


def _numeric(token: Column) -> Column:
    """The character of a numeric entity; what is no character becomes U+FFFD."""
    hexadecimal = F.nullif(F.regexp_extract(token, r"^&#[xX]0*([0-9a-fA-F]{1,6});?$", 1), F.lit(""))
    decimal = F.nullif(F.regexp_extract(token, r"^&#0*([0-9]{1,7});?$", 1), F.lit(""))
    code = F.coalesce(F.conv(hexadecimal, 16, 10), decimal).cast("bigint")
    good = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\uFFFD"))


def decode_entities(text: Column) -> Column:
    """Numeric and named entities as characters; an unknown name stays as it is."""
    def one(token: Column) -> Column:
        # the usual ones first: a look into the map goes through all its names
        return (F.when(token == "&amp;", F.lit("&")).when(token == "&lt;", F.lit("<")).when(token == "&gt;", F.lit(">"))
                 .when(token.startswith("&#") & (F.length(token) > 2), _numeric(token))
                 .when(token.startswith("&"), F.coalesce(F.try_element_at(_named(), token), token)).otherwise(token))
    return F.when(text.contains("&"), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), one), "")).otherwise(text)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _clean(text: Column) -> Column:
    """The text of a cell without its markup; nothing is NULL."""
    return _once(text, lambda t: _once(strip_ws(decode_entities(t)), lambda v: F.when(v != "", v)))


def _cell_text(c: Column) -> Column:
    return _clean(F.regexp_replace(c, _MARKUP, ""))


def _cells(row_html: Column) -> Column:
    return F.transform(F.regexp_extract_all(row_html, F.lit(_CELL), F.lit(0)), _cell_text)


def _span(cell: Column, name: str) -> Column:
    number = F.regexp_extract(cell, _SPAN % name, 1).try_cast("int")
    return F.greatest(F.lit(1), F.least(F.coalesce(number, F.lit(1)), F.lit(_MOST[name])))


def _spanning_cells(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.struct(
        _cell_text(c).alias("text"), _span(c, "colspan").alias("colspan"), _span(c, "rowspan").alias("rowspan")))


def _placed(state: Column, cell: Column) -> Column:
    """A row with one more cell: first the hanging cells whose column has come, then the cell itself."""
    texts, above, below = state["texts"], state["above"], state["below"]
    due = F.filter(above, lambda x, i: x["col"] <= F.size(texts) + i)  # each takes a column, so they are the first ones
    n = F.size(due)
    start = F.size(texts) + n
    own = F.when(cell["rowspan"] > 1, F.transform(F.sequence(F.lit(0), cell["colspan"] - 1), lambda o: F.struct(
        (start + o).alias("col"), cell["text"].alias("text"), (cell["rowspan"] - 1).alias("left")))).otherwise(F.array().cast(_HANGING))
    return F.struct(
        F.concat(texts, F.transform(due, lambda x: x["text"]), F.array_repeat(cell["text"], cell["colspan"])).alias("texts"),
        F.slice(above, n + 1, F.size(above)).alias("above"),
        F.concat(below, _one_less(due), own.cast(_HANGING)).alias("below"))


def _one_less(hanging: Column) -> Column:
    return F.transform(F.filter(hanging, lambda x: x["left"] > 1), lambda x: F.struct(
        x["col"].alias("col"), x["text"].alias("text"), (x["left"] - 1).alias("left"))).cast(_HANGING)


def _with_row(state: Column, cells: Column) -> Column:
    row_type = f"struct<texts:array<string>,above:{_HANGING},below:{_HANGING}>"
    begin = F.struct(F.array().cast("array<string>").alias("texts"), state["hanging"].alias("above"), F.array().cast(_HANGING).alias("below"))
    row = F.reduce(cells, begin.cast(row_type), lambda s, c: _placed(s, c).cast(row_type))
    return F.struct(F.concat(state["rows"], F.array(F.concat(row["texts"], F.transform(row["above"], lambda x: x["text"])))).alias("rows"),
                    F.concat(row["below"], _one_less(row["above"])).alias("hanging"))


def _grid(rows: Column) -> Column:
    """Rows of (text, colspan, rowspan) cells as rows of texts."""
    wide = F.transform(rows, lambda cells: F.flatten(F.transform(cells, lambda c: F.array_repeat(c["text"], c["colspan"]))))
    state = f"struct<rows:array<array<string>>,hanging:{_HANGING}>"
    begin = F.struct(F.array().cast("array<array<string>>").alias("rows"), F.array().cast(_HANGING).alias("hanging"))

    def whole(s: Column) -> Column:
        """With the rows that hang below the last one."""
        left = F.coalesce(F.array_max(F.transform(s["hanging"], lambda x: x["left"])), F.lit(0))
        more = F.transform(F.filter(F.sequence(F.lit(0), left), lambda k: k > 0), lambda k: F.transform(
            F.filter(s["hanging"], lambda x: x["left"] >= k), lambda x: x["text"]))
        return F.concat(s["rows"], more)

    tall = F.exists(rows, lambda cells: F.exists(cells, lambda c: c["rowspan"] > 1))
    return F.when(tall, F.reduce(rows, begin.cast(state), lambda s, cells: _with_row(s, cells).cast(state), whole)).otherwise(wide)


def _pin(df: DataFrame, keep: list[str], **exprs: Column) -> DataFrame:
    """Evaluate ``exprs`` once per row and expose them as plain columns.

    The values come out of a one-element ``inline`` generator, so the optimizer
    cannot substitute the expressions into later filters (predicate pushdown
    through a projection would re-evaluate a page-wide regex per reference).
    """
    pinned = F.inline(F.array(F.struct(*[e.alias(k) for k, e in exprs.items()])))
    return df.select(*keep, pinned)


def html_table_status(pages: DataFrame, heading_map: Mapping[str, str]) -> DataFrame:
    """Per page: the first table's heading, data rows and the load verdict.

    ``all_rows`` has the heading's rows as well.  ``status`` is ``ok``, ``missing_table`` or ``missing_columns``;
    ``missing`` lists absent mapped names, sorted.
    """
    found = F.regexp_extract(F.regexp_replace("conteudo", _COMMENT, ""), _TABLE, 0)
    staged = _pin(pages, ["doc_id"], _table=_once(found, lambda t: F.when(t != "", t)))
    staged = _pin(staged, ["doc_id", "_table"], _rows=F.regexp_extract_all(F.col("_table"), F.lit(_ROW), 1))
    is_head = lambda r: r.rlike(_HEAD_CELL) & ~r.rlike(_DATA_CELL)
    staged = _pin(staged, ["doc_id", "_table", "_rows"], _first=F.array_position(F.transform("_rows", is_head), False))
    first_data = F.col("_first")  # from 1; 0: none
    head_html = F.when(first_data != 1, F.get("_rows", F.lit(0)))
    headings = F.transform(_cells(head_html), lambda h: F.coalesce(h, F.lit("")))
    renamed = F.transform(headings, lambda h: F.coalesce(
        F.try_element_at(F.create_map(*[x for kv in heading_map.items() for x in map(F.lit, kv)]), h), h))
    staged = _pin(staged, ["doc_id", "_table", "_rows", "_first"], columns=renamed)
    required = F.array(*[F.lit(v) for v in sorted(heading_map.values())])
    missing = F.array_sort(F.array_except(required, F.coalesce("columns", F.array().cast("array<string>"))))
    status = (F.when(F.col("_table").isNull(), F.lit("missing_table"))
               .when(F.size(missing) > 0, F.lit("missing_columns"))
               .otherwise(F.lit("ok")))
    return staged.select(
        "doc_id",
        status.alias("status"),
        F.when(F.col("_table").isNull(), F.array().cast("array<string>")).otherwise(missing).alias("missing"),
        "columns",
        F.when(first_data > 0, F.slice("_rows", first_data.cast("int"), F.size("_rows")))
         .otherwise(F.array().cast("array<string>")).alias("data_rows"),
        F.col("_rows").alias("all_rows"),
    )


def html_table(pages: DataFrame, heading_map: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Data rows of each page's first table as mapped STRING columns.

    ``strict`` fails the job on a page without a table or without a mapped
    heading (the reference's load errors); otherwise such pages yield no rows
    and are reported by ``html_table_status``.
    """
    st = html_table_status(pages, heading_map)
    if strict:
        # A filter (not a projected column) so that column pruning cannot drop the check.
        st = st.where(F.when(F.col("status") == "ok", F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("page "), F.col("doc_id"), F.lit(": "), F.col("status"), F.lit(" "),
                                   F.array_join("missing", ", ")))))
    else:
        st = st.where(F.col("status") == "ok")
    # Cells are split before the explode, so each row's cells are a generator
    # output; _outer + filter avoids the inferred size() filter of a plain explode.
    # A cell of the heading may hang into the data, so the grid is that of all rows.  Only pages whose
    # rows speak of spans need it; of the others only the cells of wanted columns are read.
    spans = F.exists("all_rows", lambda r: F.lower(r).contains("span"))
    split = _pin(st, ["doc_id", "columns", "data_rows", "all_rows"], _spans=spans,
                 _html=F.transform("all_rows", lambda r: F.regexp_extract_all(r, F.lit(_CELL), F.lit(0))))
    above = F.size("all_rows") - F.size("data_rows")
    cells = F.when(F.col("_spans"), _grid(F.transform("_html", _spanning_cells))).otherwise(F.col("_html"))
    data = F.filter(cells, lambda _, i: i >= above)
    rows = (split.select("doc_id", "columns", "_spans", F.posexplode_outer(F.when(F.size("data_rows") > 0, data)).alias("row_pos", "_cells"))
                 .where(F.col("row_pos").isNotNull()))

    def text(name: str) -> Column:
        cell = F.get(F.col("_cells"), (F.array_position("columns", F.lit(name)) - 1).cast("int"))
        return F.when(F.col("_spans"), cell).otherwise(_cell_text(cell)).alias(name)

    return rows.select("doc_id", "row_pos", *[text(name) for name in heading_map.values()])
