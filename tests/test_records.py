"""Large files in several tasks give the records of the whole document, wherever they are split."""

import json
import random

import pytest

from lakefold.session import fresh_path
from lakefold.sources import records
from lakefold.sources.documents import invoice_elements_from_json, xml_to_json


@pytest.fixture
def splits(spark):
    def set_size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield set_size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def put(spark, path, text):
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    out = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file, True)
    out.write(bytearray(text.encode()))
    out.close()


def element(draw, i):
    texts = ['a "quoted" } text', "{[", "}]", "back\\slash", "\\", "é\n\t", "", 'ends with \\"', "x" * draw.choice([1, 30, 700])]
    return {"id": f"P{i}", "nome": draw.choice(texts), "n": draw.choice([1, 2.5, None, True]),
            "tarefas": [{"t": draw.choice(texts), "sub": {"a": [1, {"b": draw.choice(texts)}]}} for _ in range(draw.randint(0, 4))]}


@pytest.mark.parametrize("size,indent", [(100, None), (700, 2)])
def test_json_elements_wherever_the_file_is_split(spark, splits, monkeypatch, size, indent):
    draw = random.Random(size)
    monkeypatch.setattr(records, "STRETCH", size // 2)
    path, want = fresh_path(spark, "t-json"), []
    for f in range(2):
        rows = [element(draw, draw.randint(0, 40)) for _ in range(draw.randint(5, 22))]
        rows += rows[:2]  # repeated elements
        whole = {"versao": "2 { [", "outros": [{"id": "not this"}], "meta": {"projetos": [{"id": "nor this"}]}, "projetos": rows, "fim": [[1], {"id": "x"}]}
        put(spark, f"{path}/f{f}.json", json.dumps(whole, indent=indent, ensure_ascii=f == 0) + ("\n" if f else ""))
        want += rows
    splits(size)
    assert records._pieces(spark, path, "}").rdd.getNumPartitions() > 3
    got = records.scan_json_documents(spark, path, "projetos").collect()
    found = [json.loads(r.conteudo)["projetos"] for r in got]
    assert all(len(x) == 1 for x in found)
    order = lambda x: json.dumps(x, sort_keys=True)
    assert sorted((x[0] for x in found), key=order) == sorted(want, key=order)
    assert len({r.doc_id for r in got}) == len(got)


def test_ids_do_not_depend_on_files_or_splits(spark, splits):
    rows = [{"id": i % 5, "t": "y" * 200} for i in range(40)]
    one, many = fresh_path(spark, "t-one"), fresh_path(spark, "t-many")
    put(spark, f"{one}/all.json", json.dumps({"projetos": rows}))
    for i in range(8):
        put(spark, f"{many}/{i}.json", json.dumps({"projetos": rows[i * 5:i * 5 + 5]}) + "\n")
    splits(500)
    a, b = (sorted((r.doc_id, r.conteudo) for r in records.scan_json_documents(spark, p, "projetos").collect()) for p in (one, many))
    assert a == b and len(a) == 40


@pytest.mark.parametrize("text", ['{"projetos":[{"id":1}', '{"projetos":[{"id":1},{"id":', '{"projetos":[{"id":"} ]}'])
def test_json_that_is_cut_off_fails(spark, text):
    path = fresh_path(spark, "t-cut")
    put(spark, f"{path}/a.json", text)
    with pytest.raises(ValueError, match="ends inside"):
        records.scan_json_documents(spark, path, "projetos").collect()


def test_json_without_the_array(spark):
    path = fresh_path(spark, "t-none")
    put(spark, f"{path}/a.json", '{"other": [{"a": 1}], "projetos": []}\n')
    assert records.scan_json_documents(spark, path, "projetos").count() == 0


def xml_file(draw, n, serie):
    rows = "\n".join(f'  <Nota id="{draw.randint(0, 20)}"><N>{i % 9:03d}</N><NotaRef>{"z" * draw.choice([0, 5, 300])}</NotaRef></Nota>' for i in range(n))
    return f'<?xml version="1.0"?>\n<!-- <Nota> -->\n<Notas versao="{serie}">\n{rows}\n</Notas>\n'


@pytest.mark.parametrize("size", [300])
def test_xml_records_wherever_the_file_is_split(spark, splits, size):
    import xml.etree.ElementTree as ET
    draw, path, want = random.Random(size), fresh_path(spark, "t-xml"), []
    for f in range(3):
        text = xml_file(draw, draw.randint(1, 50), f)
        put(spark, f"{path}/f{f}.xml", text)
        want += [(str(f), e.get("id"), e.find("N").text, e.find("NotaRef").text) for e in ET.fromstring(text.split("?>")[1]).iter("Nota")]
    splits(size)
    docs = records.scan_xml_documents(spark, path, "Nota")
    trees = [json.loads(r.conteudo)["Notas"] for r in xml_to_json(docs).collect()]
    got = [(t["@versao"], t["Nota"]["@id"], t["Nota"]["N"], t["Nota"]["NotaRef"]) for t in trees]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert docs.select("doc_id").distinct().count() == len(want)


def test_xml_that_is_cut_off_fails(spark):
    path = fresh_path(spark, "t-xml-cut")
    put(spark, f"{path}/a.xml", "<Notas><Nota><N>1</N></Nota><Nota><N>2</N>")
    whole = records.scan_xml_documents(spark, path, "Nota")
    assert whole.count() == 2
    put(spark, f"{path}/a.xml", "<Notas><Nota><N>1</N></Nota><Nota><N>2")
    with pytest.raises(Exception):
        xml_to_json(records.scan_xml_documents(spark, path, "Nota")).collect()


def test_lone_children_are_kept_by_way_of_json(spark):
    docs = spark.createDataFrame([("d", "<NotasFiscais v='1'><NotaFiscal><NumeroNota>07</NumeroNota><Impostos><ISS>1.50</ISS></Impostos>"
                                   "<Itens><Item><Descricao>a</Descricao></Item></Itens></NotaFiscal></NotasFiscais>"), ("e", "<NotasFiscais/>")],
                                 "doc_id string, conteudo string")
    rows = invoice_elements_from_json(xml_to_json(docs)).collect()
    assert [(r.doc_id, r.pos, r.NumeroNota, r.ISS, r.PIS, [i.Descricao for i in r.Itens]) for r in rows] == [("d", 0, "07", "1.50", None, ["a"])]


def test_whole_tree_as_json(spark):
    xml = ('<?xml version="1.0" encoding="UTF-8"?><!-- c --><R versao="2" q=\'x\'><Serie tipo="A">007</Serie><E/><L>1</L><L> 2.0 </L><D>2024-01-05</D>'
           '<T>a &amp; &lt;b&gt; = "c"</T><C><![CDATA[<raw n="1">]]></C><B>true</B></R>')
    docs = spark.createDataFrame([("a", xml), ("n", None)], "doc_id string, conteudo string")
    got = {r.doc_id: r.conteudo for r in xml_to_json(docs).collect()}
    assert got["n"] is None
    assert json.loads(got["a"]) == {"R": {"@versao": "2", "@q": "x", "Serie": {"@tipo": "A", "#text": "007"}, "E": None, "L": ["1", "2.0"],
                                          "D": "2024-01-05", "T": 'a & <b> = "c"', "C": '<raw n="1">', "B": "true"}}
    with pytest.raises(Exception):
        xml_to_json(spark.createDataFrame([("b", "<a><b></a>")], "doc_id string, conteudo string")).collect()
