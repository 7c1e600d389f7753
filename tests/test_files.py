"""Captures, archives, spreadsheets, images, sections and paged scans from small files made here."""

import gzip
import io
import struct
import zipfile

from pyspark.sql import functions as F

from tallyspark.operators import boards
from tallyspark.sources import captures, files


def trade(kind, symbol, size, price, trade_id, at, flags=0):
    return struct.pack("<cBq8sIqq", kind, flags, at, symbol.ljust(8).encode(), size, price, trade_id)


def event(code, at):
    return struct.pack("<ccq", b"S", code, at)


def frame(messages, vlan=False):
    body = b"".join(struct.pack("<H", len(m)) + m for m in messages)
    segment = struct.pack("<BBHIIHHqqq", 1, 0, 0x8003, 1, 1, len(body), len(messages), 0, 1, 0) + body
    udp = struct.pack(">HHHH", 1, 2, len(segment) + 8, 0) + segment
    ip = struct.pack(">BBHHHBBHII", 0x45, 0, len(udp) + 20, 0, 0, 1, 17, 0, 0, 0) + udp
    return bytes(12) + (struct.pack(">HH", 0x8100, 5) if vlan else b"") + struct.pack(">H", 0x0800) + ip


def pcap(frames, order="<"):
    head = struct.pack(f"{order}IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    return head + b"".join(struct.pack(f"{order}IIII", 0, 0, len(f), len(f)) + f for f in frames)


def pcapng(frames):
    def block(kind, body):
        body += bytes(-len(body) % 4)
        return struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)

    parts = [block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)), block(1, struct.pack("<HHI", 1, 0, 0))]
    return b"".join([*parts, *[block(6, struct.pack("<IIIII", 0, 0, 0, len(f), len(f)) + f) for f in frames]])


FRAMES = [frame([event(b"O", 1), trade(b"T", "ABC", 100, 123400, 7, 5)]), b"\x00" * 60, frame([trade(b"B", "ABC", 100, 123400, 7, 6), b"Q" * 42], vlan=True)]


def test_captures(spark, tmp_path):
    whole = {"a.pcap": pcap(FRAMES), "b.pcap": pcap(FRAMES, ">"), "c.pcapng": pcapng(FRAMES), "d.pcap.gz": gzip.compress(pcap(FRAMES))}
    cut = {"e.pcap": pcap(FRAMES)[:-5], "f.pcap": b"", "g.pcap.gz": gzip.compress(pcap(FRAMES))[:-40]}
    for name, data in (whole | cut).items():
        (tmp_path / name).write_bytes(data)
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in whole | cut] + [(None,)], "path string")
    rows = captures.read_captures(paths).collect()
    got = {n: sorted((r["seq"], r["type"], r["event"], r["at_nanos"], r["symbol"], r["size"], r["price_e4"], r["trade_id"], r["complete"]) for r in rows if r["path"].endswith(f"/{n}")) for n in whole | cut}
    want = [(0, "S", "O", 1, None, None, None, None, None), (1, "T", None, 5, "ABC", 100, 123400, 7, None), (2, "B", None, 6, "ABC", 100, 123400, 7, None), (3, "end", None, None, None, None, None, None, True)]
    assert all(got[n] == want for n in whole)
    assert got["e.pcap"] == [*want[:2], (2, "end", None, None, None, None, None, None, False)]
    assert got["f.pcap"] == [(0, "end", None, None, None, None, None, None, True)]
    assert got["g.pcap.gz"][-1][1] == "end" and got["g.pcap.gz"][-1][-1] is False


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return out.getvalue()


def binary(spark, contents):
    return spark.createDataFrame(list(contents.items()), "path string, content binary")


def test_zipped_lines(spark):
    df = binary(spark, {"a.zip": zipped({"x.txt": "1|AB|c\r\n2||d", "empty.txt": ""}), "bad.zip": b"no archive", "none.zip": None})
    got = sorted(((r["path"], r["member"], r["line_no"], r["cells"]) for r in files.zipped_lines(df).collect()), key=repr)
    assert got == [("a.zip", "x.txt", 0, ["1", "AB", "c"]), ("a.zip", "x.txt", 1, ["2", "", "d"]), ("bad.zip", None, None, None), ("none.zip", None, None, None)]


def test_sheets_with_a_header_found_by_content(spark):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = f"<sst {ns}><si><t>Country</t></si><si><r><t>Tax </t></r><r><t>rate</t></r></si><si><t>Peru</t></si></sst>"
    sheet = f"""<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>Notes</t></is></c></row>
      <row r="3"><c r="B3" t="s"><v>0</v></c><c r="D3" t="s"><v>1</v></c></row><row r="4"><c r="B4" t="s"><v>2</v></c><c r="D4"><v>0.295</v></c></row></sheetData></worksheet>"""
    df = binary(spark, {"t.xlsx": zipped({"xl/sharedStrings.xml": strings, "xl/worksheets/sheet1.xml": sheet})})
    rows = files.sheet_rows(df)
    assert [r["cells"] for r in rows.orderBy("row_no").collect()] == [["Notes"], [None, "Country", None, "Tax rate"], [None, "Peru", None, "0.295"]]
    (found,) = files.after_header(rows, ["path", "sheet"], "^tax").collect()
    assert found["cells"] == [None, "Peru", None, "0.295"] and found["header"] == [None, "Country", None, "Tax rate"]


def test_image_blocks(spark):
    image = b"P5\n# made here\n24 12\n255\n" + b"".join(bytes([255] * 12 + [0] * 6 + [100] * 6) for _ in range(12))
    got = [tuple(r)[1:] for r in files.image_blocks(binary(spark, {"i.pgm": image})).orderBy("col").collect()]
    assert got == [(0, 0, 255.0, 0.0, 1.0), (0, 1, 50.0, 50.0, 0.0)]
    (bad,) = files.image_blocks(binary(spark, {"j.pgm": image[:100]})).collect()
    assert bad["mean"] is None


def test_sections(spark):
    html = "<h1>Top</h1>lead<p>one <b>two</b><script>x()</script></p><table><tr><td>a<td>b<p>c</p></table>tail<ul><li>i<li>j</ul>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id long, html string")
    got = [(r["id"], r["k"], r["tag"], r["body"]) for r in files.sections(pages, "id", "html").orderBy("id", "k").collect()]
    assert got == [(1, 0, "h1", "Top"), (1, 1, "body", "lead"), (1, 2, "p", "one two"), (1, 3, "table", "a b c"), (1, 4, "body", "tail"), (1, 5, "li", "i"), (1, 6, "li", "j")]


def test_paged_scans(spark):
    pages = [
        ("a", 0, 2, ["1", "2"], 3, False), ("a", 1, 2, ["3"], 3, False), ("a", 2, 2, ["9"], 3, False),
        ("b", 0, 2, ["1", "2"], 9, False), ("b", 1, 2, ["1", "2"], 9, False),
        ("c", 0, 2, ["1", "2"], 9, False), ("c", 1, 2, ["3", "4"], 9, True), ("d", 0, 2, ["1", "2"], 4, False), ("d", 1, 2, ["3", "4"], 5, False), ("d", 2, 2, [], 5, False),
        ("e", 0, 2, ["1", "2"], None, False), ("e", 1, 2, ["3", "4"], None, False),
    ]
    df = spark.createDataFrame(pages, "board string, page int, asked int, keys array<string>, total int, failed boolean")
    got = {r["board"]: (r["verdict"], r["rows"]) for r in boards.pass_verdicts(df, 2).collect()}
    assert got == {"a": ("complete", 3), "b": ("replay", 2), "c": ("failures", 4), "d": ("unstable", 4), "e": ("budget", 4)}


def test_two_passes_that_agree(spark):
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")], "board string, key int, v string")
    second = spark.createDataFrame([("a", 2, "y"), ("a", 1, "y"), ("b", 3, "y")], "board string, key int, v string")
    got = sorted(tuple(r[c] for c in ("board", "key", "v", "agreed")) for r in boards.agreed_rows(first, second, "board", "key").collect())
    assert got == [("a", 1, "x", True), ("a", 2, "x", True), ("b", 1, "x", False), ("b", 3, "y", False)]
    assert boards.agreed_rows(first.limit(0), second.limit(0), "board", "key").select(F.count("*")).first()[0] == 0
