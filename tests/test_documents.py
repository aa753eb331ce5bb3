import random

from pyspark.sql import functions as F

from barlake.operators import documents as docs


def blocks(spark, text):
    df = spark.createDataFrame([("1", text)], "code string, text string")
    return docs.doc_blocks(docs.doc_sections(df))


def kinds(spark, body):
    rows = blocks(spark, f"=== s ===\n{body}").orderBy("block_no").collect()
    return [(r.kind, r.lines) for r in rows]


def test_sections(spark):
    text = "dropped\n=== a ===\nx\n=== b ===\n \n\n===   ===\ny\n=== c ===\nz === d ===\n=== e === \n"
    df = spark.createDataFrame([("1", text)], "code string, text string")
    got = [(r.name, r.body) for r in docs.doc_sections(df).orderBy("section_no").collect()]
    assert got == [("a", "\nx\n"), ("c", "\nz === d ===\n=== e === \n")]


def test_assemble_then_split_is_identity(spark):
    rng = random.Random(5)
    parts = [(str(i % 7), f"cat{i:03d}", "\n".join(f"line {rng.random()}" for _ in range(rng.randrange(1, 5)))) for i in range(60)]
    df = spark.createDataFrame(parts + [("0", "blank", " \n　")], "code string, category string, text string")
    back = docs.doc_sections(docs.doc_assemble(df))
    got = {(r.code, r.name, r.body.strip("\n")) for r in back.collect()}
    assert got == set(parts)


def test_block_kinds(spark):
    body = "\n".join([
        "title ◇000001 Name", "★ star", "　", "【1.x】tail", "p1", "p2", "【2】", "免责条款 a", "b", "",
        "┌─┐", "│a│", "", "└─┘", "after", "────", "─────", "x", "",
        "──┬──", "d│t", "──┴──", "body", "", "rest",
    ])
    assert kinds(spark, body) == [
        ("heading", ["【1.x】tail"]), ("paragraph", ["p1", "p2"]), ("heading", ["【2】"]),
        ("disclaimer", ["免责条款 a", "b"]), ("table", ["┌─┐", "│a│", "", "└─┘"]),
        ("dash_table", ["after", "────", "─────", "x"]),
        ("announcement", ["──┬──", "d│t", "──┴──", "body"]), ("paragraph", ["rest"]),
    ]


def test_unclosed_blocks_run_to_the_end(spark):
    assert kinds(spark, "┌─┐\n│a│\n\nx") == [("table", ["┌─┐", "│a│", "", "x"])]
    assert kinds(spark, "─┬─\na│b\n\nx") == [("announcement", ["─┬─", "a│b", "", "x"])]


def table(spark, lines):
    out = docs.doc_table_rows(blocks(spark, "=== s ===\n" + "\n".join(lines)))
    return [(r.is_header, r.is_span, r.cells) for r in out.orderBy("row_no").collect()]


def test_table_rows(spark):
    got = table(spark, ["┌┬┬┐", "│★h1│h2│h3│", "├┼┼┤", "│a│1│2│", "│ │3│ │", "│b│ │ │", "│lab│only│ │", "│x│y│", "└┴┴┘"])
    assert got == [
        (True, False, ["h1", "h2", "h3"]), (False, False, ["a b", "13", "2"]),
        (False, True, ["lab", "only"]), (False, True, ["x", "y"]),
    ]


def test_table_without_rules_has_only_one_header(spark):
    assert table(spark, ["┌┐", "│a│b│", "│c│d│", "└┘"]) == [(True, False, ["a", "b"]), (False, False, ["c", "d"])]
    assert table(spark, ["┌┐", "├┤", "│a│b│", "└┘"]) == [(False, False, ["a", "b"])]
    assert table(spark, ["┌┐", "└┘"]) == []


def test_announcement_ends_at_first_blank_line(spark):
    text = "=== s ===\n──┬──\n 2024-01-01│T│U\n──┴──\n one\n\n two\n──┬──\n d2│\n──┴──\n lost"
    out = docs.doc_announcements(blocks(spark, text))
    assert [(r.date, r.title, r.body) for r in out.collect()] == [("2024-01-01", "T│U", "one")]


def test_dash_table(spark):
    out = docs.doc_dash_table(blocks(spark, "=== s ===\nhead\n─────\na 1\n─────\n─────\nb 2\n─────"))
    assert [(r.intro, r.pre_text) for r in out.collect()] == [("head", "a 1\n\n\nb 2")]


def test_html_of_document_without_sections(spark):
    df = spark.createDataFrame([("1", "no sections")], "code string, text string")
    html = docs.doc_render_html(df).first().html
    assert "<nav>" not in html and html.endswith("</body>\n</html>\n")


def test_whole_long_documents(spark):
    """No prefix, no stack overflow, and linear time on one very long report."""
    n = 30000
    text = "=== s ===\n┌─┐\n" + "\n".join(f"│k{i}│v{i}│w│" for i in range(n)) + "\n└─┘\n" + "\n".join(f"line {i}" for i in range(n))
    b = blocks(spark, text)
    assert [(r.kind, r.n) for r in b.select("kind", F.size("lines").alias("n")).collect()] == [("table", n + 2), ("paragraph", n)]
    rows = docs.doc_table_rows(b)
    assert rows.count() == n
    assert rows.filter("row_no = 30000").first().cells == ["k29999", "v29999", "w"]
