"""Shredding JSON and XML documents into element rows.

A document is parsed once with a declared schema (``from_json`` /
``from_xml``) instead of one path lookup per field.  Leaf values are read as
STRING and cast afterwards, so the tolerant/strict cast choice stays explicit.
Each element keeps its document id and position: that pair identifies it, and
child rows carry it through the explode instead of re-joining on a business
number, which would multiply children of repeated numbers.

Arrays produced by a parser are exploded with the ``_outer`` generator and the
empty rows filtered afterwards: with a plain ``explode`` the optimizer infers a
``size(array) > 0`` filter *below* the projection and evaluates the parser
twice per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from json.encoder import encode_basestring
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.fixed import TAX_TYPES
from lakefold.sources.html import _once

# Declared document schemas (all leaves STRING).
TASK_FIELDS = ["id_tarefa", "descricao", "data_inicio", "data_prevista_fim", "responsavel_tarefa",
               "status_tarefa", "horas_estimadas", "horas_realizadas"]
PROJECT_FIELDS = ["id_projeto", "nome_projeto", "cliente_id", "responsavel", "data_inicio",
                  "data_prevista_fim", "status", "valor_projeto", "horas_totais_estimadas",
                  "horas_totais_realizadas"]
FAILFAST = {"mode": "FAILFAST"}  # a malformed document fails the load; see ``document_rejects``

PROJECTS_SCHEMA = ("projetos array<struct<" + ",".join(f"{f}:string" for f in PROJECT_FIELDS)
                   + ",tarefas:array<struct<" + ",".join(f"{f}:string" for f in TASK_FIELDS) + ">>>>")

INVOICE_FIELDS = ["NumeroNota", "DataEmissao", "ClienteID", "ValorServico", "ValorTotal"]
TAX_FIELDS = list(TAX_TYPES)
ITEM_FIELDS = ["Descricao", "Quantidade", "ValorUnitario"]
INVOICE_COLUMNS = [*INVOICE_FIELDS, *TAX_FIELDS, "Itens"]


def _invoice_element(columns) -> str:
    def texts(fields) -> str:
        return ",".join(f"{f}:string" for f in fields)

    head, taxes = ([f for f in fields if f in columns] for fields in (INVOICE_FIELDS, TAX_FIELDS))
    return "struct<" + ",".join([texts(head)] * bool(head) + [f"Impostos:struct<{texts(taxes)}>"] * bool(taxes)
                                + [f"Itens:struct<Item:array<struct<{texts(ITEM_FIELDS)}>>>"] * ("Itens" in columns)) + ">"


INVOICE_ELEMENT = _invoice_element(INVOICE_COLUMNS)
# The root <NotasFiscais> holds a repeated <NotaFiscal>.  Declaring the element
# as an array keeps a lone child (the dict-based converter would turn it into
# an object and lose it).
INVOICES_SCHEMA = f"NotaFiscal array<{INVOICE_ELEMENT}>"


def explode_parsed(df: DataFrame, array_col: str, as_name: str) -> DataFrame:
    """Rows (other columns…, pos, ``as_name``) per array element; NULL/empty arrays give none."""
    keep = [c for c in df.columns if c != array_col]
    return (df.select(*keep, F.posexplode_outer(array_col).alias("pos", as_name))
              .where(F.col("pos").isNotNull()))


def json_array_rows(docs: DataFrame, array_path: str = "projetos",
                    schema: str = PROJECTS_SCHEMA) -> DataFrame:
    """One row per element of the top-level array: (doc_id, pos, element)."""
    parsed = docs.select("doc_id", F.from_json("conteudo", schema, FAILFAST)[array_path].alias("_arr"))
    return explode_parsed(parsed, "_arr", "element")


def document_rejects(docs: DataFrame, kind: str) -> DataFrame:
    """Documents of ``kind`` (``json`` or ``xml``) that their parser would fail on:
    ``doc_id`` and ``reason`` (``missing`` or ``malformed``)."""
    corrupt, parse = "_corrupt", {"json": F.from_json, "xml": F.from_xml}[kind]
    schema = (PROJECTS_SCHEMA if kind == "json" else INVOICES_SCHEMA) + f", {corrupt} string"
    tried = docs.select("doc_id", F.col("conteudo").isNull().alias("missing"),
                        parse("conteudo", schema, {"columnNameOfCorruptRecord": corrupt}).alias("parsed"))
    reason = F.when(F.col("missing"), F.lit("missing")).when(F.col("parsed")[corrupt].isNotNull(), F.lit("malformed"))
    return tried.select("doc_id", reason.alias("reason")).where(F.col("reason").isNotNull())


def project_elements(docs: DataFrame) -> DataFrame:
    """Project objects of JSON project documents, fields as STRING."""
    rows = json_array_rows(docs)
    return rows.select("doc_id", "pos", *[F.col("element")[f].alias(f) for f in PROJECT_FIELDS],
                       F.col("element")["tarefas"].alias("tarefas"))


def task_elements(docs: DataFrame) -> DataFrame:
    """Task objects nested in projects (two-level unnest), with the project id.

    Accepts documents or already parsed project elements (``project_elements``).
    """
    projects = docs if "tarefas" in docs.columns else project_elements(docs)
    return projects.select(F.col("id_projeto"), F.explode("tarefas").alias("t")) \
                   .select("id_projeto", *[F.col("t")[f].alias(f) for f in TASK_FIELDS])


def invoice_elements(docs: DataFrame, columns=INVOICE_COLUMNS) -> DataFrame:
    """``NotaFiscal`` elements of XML invoice documents: (doc_id, pos, ``columns``…).

    The parser reads every document to its end and fails on a malformed one, whatever
    ``columns`` are wanted; the texts of others are not made into values.
    """
    schema = f"NotaFiscal array<{_invoice_element(columns)}>"
    parsed = docs.select("doc_id", F.from_xml("conteudo", schema, FAILFAST)["NotaFiscal"].alias("_arr"))
    el, n = explode_parsed(parsed, "_arr", "n"), F.col("n")
    return el.select("doc_id", "pos", *[(n["Itens"]["Item"] if c == "Itens" else n["Impostos"][c] if c in TAX_FIELDS else n[c]).alias(c)
                                        for c in columns])


# A character of the private use area before every text and attribute value keeps the
# parser from reading numbers, dates or booleans out of them (`007` must stay `007`).
_MARK = "\uE000"
_ROOT = r"(?s)^(?:\s|\uFEFF|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>)*+<([^\s/>]+)"
_VARIANT = {"attributePrefix": "@", "valueTag": "#text", **FAILFAST}

# Finding out that a text is no number, date or timestamp costs the parser an exception each, so texts of
# plain characters go through it as numbers: these digits and six more, the place of the text among the
# pieces that ``<`` parts.  Documents with any of _NOT_PLAIN in them have none.
_DIGITS = "8305518274016"
_FIRST, _PIECES = 100_000, 900_000
_NOT_PLAIN = ("<!", "<?", "&#", _DIGITS, _MARK, "\uFFFE", "\uFFFF")
_PLAIN = r'^[^>]*+> *+[^\x00-\x20>&"\\][^\x00-\x1F>&"\\]*+$'


def xml_tree(xml) -> Column:
    """The whole tree of an XML document as JSON text under its root's name, without a schema.

    An element that repeats inside its parent is an array, any other a value; attributes
    are ``@name``, the text beside attributes or elements is ``#text`` (an array if
    elements part it), an element with nothing in it is null.  Leaves stay text.
    """
    xml = F.col(xml) if isinstance(xml, str) else xml
    bare = F.regexp_replace(xml, r"(?s)^\s*(?:\uFEFF\s*)?<\?xml\s.*?\?>", "")  # the declaration's values must stay as they are
    body = _once(bare, lambda b: _once(F.split(b, "<"), lambda pieces: _tree_of(b, pieces)))
    return F.when(xml.isNotNull(), F.concat(F.lit('{"'), F.regexp_extract(xml, _ROOT, 1), F.lit('":'), body, F.lit("}")))


def _tree_of(xml: Column, pieces: Column) -> Column:
    def mark(c: Column) -> Column:
        return F.regexp_replace(c, r"(>\s*+)([^<\s])", f"$1{_MARK}$2")

    def number(piece: Column, i: Column) -> Column:
        place = F.concat(F.substring_index(piece, ">", 1), F.lit(f">{_DIGITS}"), (i + _FIRST).cast("string"))
        return F.when(piece.endswith(">"), piece).when(piece.rlike(_PLAIN), place).otherwise(mark(piece))

    def text(part: Column, i: Column) -> Column:
        piece = F.get(pieces, F.substring(part, 1, 6).cast("int") - _FIRST)
        return F.when(i == 0, part).otherwise(F.concat(F.lit('"'), F.trim(F.substring_index(piece, ">", -1)), F.lit('"'), part.substr(F.lit(7), F.length(part))))

    def tree(texts: Column) -> Column:
        marked = F.when(texts.contains("=") | texts.contains("<!"), F.regexp_replace(texts, r"""(=\s*["']|<!\[CDATA\[)""", f"$1{_MARK}")).otherwise(texts)
        return F.coalesce(F.to_json(F.from_xml(marked, "variant", _VARIANT)), F.lit("null"))

    plain = F.size(pieces) <= _PIECES
    for other in _NOT_PLAIN:
        plain = plain & ~xml.contains(other)
    restored = F.when(plain, F.array_join(F.transform(F.split(tree(F.array_join(F.transform(pieces, number), "<")), _DIGITS), text), "")).otherwise(tree(mark(xml)))
    return F.replace(restored, F.lit(_MARK), F.lit(""))


# Most documents are elements, attributes and texts and nothing else.  Their trees are read by the parser of
# the standard library, a batch at a time; any other document, also one that is no XML, is left to ``xml_tree``.
_LONGEST = 1 << 20  # characters of a document that is read so
_BLANK = " \t\r\n"
_OTHER = ("<!", "<?", "&#", "xmlns", _MARK, "\uFFFE", "\uFFFF")


class _Unsure(ValueError):
    """A document that is left to ``xml_tree``."""


@lru_cache(maxsize=1 << 12)
def _members(names: tuple[str, ...]) -> list[tuple[str, str]] | None:
    """The names of an object in order, each with its JSON text; None where ``xml_tree`` may take names as equal."""
    plain = "".join(names).isascii() and not any("{" in n for n in names) and len({n.lower() for n in names}) == len(names)
    return [(n, f'"{n}":') for n in sorted(names)] if plain else None


def _text_json(text: str) -> str:
    trimmed = text.strip(" ")
    if not trimmed or not trimmed.isprintable():  # a blank element, line ends or control characters
        raise _Unsure
    return encode_basestring(trimmed)


def _node_json(node: ElementTree.Element) -> str:
    """An element that has attributes or elements."""
    found: dict[str, str | list[str]] = {}
    for name, value in node.items():
        if value != value.strip(" "):
            raise _Unsure
        found["@" + name] = _text_json(value)
    texts = [node.text] if node.text else []
    for child in node:
        name, text = child.tag, child.text
        value = _node_json(child) if len(child) or child.keys() else _text_json(text) if text else "null"
        if name not in found:
            found[name] = value
        elif isinstance(held := found[name], list):
            held.append(value)
        else:
            found[name] = [held, value]
        if child.tail:
            texts.append(child.tail)
    if texts and (pieces := [_text_json(t) for t in texts if t.strip(_BLANK)]):
        found["#text"] = pieces[0] if len(pieces) == 1 else pieces
    if (members := _members(tuple(found))) is None:
        raise _Unsure
    return "{" + ",".join([start + value if isinstance(value := found[n], str) else f"{start}[{','.join(value)}]" for n, start in members]) + "}"


def _tree_json(xml: str | None) -> str | None:
    """The tree of a document as ``xml_tree`` writes it; None for a document left to it."""
    if xml is None or len(xml) > _LONGEST or not (xml.startswith("<") and xml.endswith(">")) or any(o in xml for o in _OTHER):
        return None
    try:
        root = ElementTree.fromstring(xml)
        return f"{{{_members((root.tag,))[0][1]}{_node_json(root)}}}" if _members((root.tag,)) and (len(root) or root.keys()) else None
    except (ElementTree.ParseError, _Unsure, RecursionError):
        return None


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.columns
        trees = [_tree_json(t) for t in texts.to_pylist()]
        rest = [t if tree is None else None for t, tree in zip(texts.to_pylist(), trees, strict=True)]
        yield pa.RecordBatch.from_arrays([ids, pa.array(trees, texts.type), pa.array(rest, texts.type)], ["doc_id", "tree", "rest"])


def xml_to_json(docs: DataFrame) -> DataFrame:
    """XML documents as JSON text of their whole trees (see ``xml_tree``): (doc_id, conteudo).  A document that is
    no XML fails the load."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    tried = docs.select("doc_id", "conteudo").mapInArrow(_trees, f"doc_id {id_type}, tree string, rest string")
    return tried.select("doc_id", F.coalesce("tree", xml_tree("rest")).alias("conteudo"))


def as_array(text) -> Column:
    """JSON text of an array: a lone value becomes an array of one, an absent one an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.isNull(), F.lit("[]")).when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))


def invoice_elements_from_json(json_docs: DataFrame, root: str = "NotasFiscais") -> DataFrame:
    """``NotaFiscal`` elements of invoice documents already converted to JSON
    (the ``xml_to_json`` bronze table): same rows as ``invoice_elements``.  A lone
    invoice or item, an object in the tree, is kept."""
    invoices = "array<struct<" + ",".join(f"{f}:string" for f in (*INVOICE_FIELDS, "Impostos", "Itens")) + ">>"
    items = "array<struct<" + ",".join(f"{f}:string" for f in ITEM_FIELDS) + ">>"
    taxes = "struct<" + ",".join(f"{f}:string" for f in TAX_FIELDS) + ">"
    # a field declared as text holds the JSON text of whatever is below it
    top = json_docs.select("doc_id", F.from_json("conteudo", f"{root} struct<NotaFiscal:string>", FAILFAST)[root]["NotaFiscal"].alias("_notas"))
    parsed = top.select("doc_id", F.from_json(as_array("_notas"), invoices, FAILFAST).alias("_arr"))
    el = explode_parsed(parsed, "_arr", "n")
    below = el.select("doc_id", "pos", "n", F.from_json(F.col("n")["Impostos"], taxes, FAILFAST).alias("_taxes"),
                      F.from_json(F.col("n")["Itens"], "Item string", FAILFAST)["Item"].alias("_item"))
    return below.select("doc_id", "pos", *[F.col("n")[f].alias(f) for f in INVOICE_FIELDS], *[F.col("_taxes")[f].alias(f) for f in TAX_FIELDS],
                        F.when(F.col("_item").isNotNull(), F.from_json(as_array("_item"), items, FAILFAST)).alias("Itens"))
