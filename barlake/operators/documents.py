"""Company reports as data: sections, blocks, table rows, announcements, HTML.

A report is one row. Its grammar is regular, so sections and blocks are found by regular
expressions and everything below them by higher-order functions: no Python process and,
apart from assembling reports out of their parts, no shuffle. The patterns use only
single-character lazy repetitions, which Java runs as loops, so a report of any length
is matched whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import doc_escape_link, escape, has_text, let, short_hash, strip
from ..functions.text import SPACE

_GAP = rf"[{SPACE}&&[^\n]]*+"  # white space inside a line
_ANY = r"(?s:.*?)"
_SECTION = r"(?dm)^=== (.+?) ===$"

# What the first line of each kind of block looks like.
_HEADING = rf"{_GAP}【\p{{Nd}}"
_DISCLAIMER = r"[^\n]*免责条款"
_TABLE = rf"{_GAP}┌"
_ANNOUNCEMENT = rf"{_GAP}─[^\n]*┬"
_DASHES = rf"(?:\A|\n){_GAP}─{{5,}}{_GAP}(?:\n|\z)"

_BLANK_AHEAD = rf"(?=\n{_GAP}(?:\n|\z)|\z)"
_STOP = rf"(?=\n{_GAP}(?:\n|\z|┌|─[^\n]*┬|【\p{{Nd}}|[^\n]*免责条款)|\z)"

# One alternative per kind, in order of precedence; consecutive matches are the blocks.
_BLOCK = "|".join([
    rf"{_HEADING}[^\n]*",
    rf"{_DISCLAIMER}[^\n]*{_ANY}{_BLANK_AHEAD}",
    rf"{_TABLE}[^\n]*{_ANY}(?:(?<=\n){_GAP}└[^\n]*|\z)",
    rf"{_ANNOUNCEMENT}[^\n]*(?:\n{_ANY}┴[^\n]*{_ANY}{_STOP}|(?s:.*))",
    rf"{_GAP}[^{SPACE}][^\n]*{_ANY}{_STOP}",
])


# ---- corpus level ---------------------------------------------------------------


def doc_assemble(
    parts: DataFrame,
    code: str = "code",
    category: str = "category",
    text: str = "text",
    order: str | None = None,
) -> DataFrame:
    """Category texts of each code joined into one report; blank texts are dropped.

    The result is one string per code, so a code's categories (a small fixed set) must
    fit one row; blank parts are removed before the shuffle.
    """
    part = F.concat(F.lit("=== "), F.col(category), F.lit(" ===\n"), F.col(text))
    rank = F.col(category if order is None else order)
    return (
        parts.filter(has_text(F.col(text)))
        .groupBy(code)
        .agg(F.array_sort(F.collect_list(F.struct(rank.alias("r"), part.alias("t")))).alias("p"))
        .select(code, F.array_join(F.transform("p", lambda p: p["t"]), "\n\n").alias("text"))
    )


def doc_hash(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumns(
        {"file_size": F.octet_length(text).cast("bigint"), "file_hash": short_hash(F.col(text))}
    )


def doc_changed(
    docs: DataFrame, known: DataFrame, code: str = "code", digest: str = "file_hash"
) -> DataFrame:
    """Documents whose (code, hash) has not been seen."""
    return docs.join(known.select(code, digest), [code, digest], "left_anti").select(*docs.columns)


# ---- sections -------------------------------------------------------------------


def sections_of(text: Column) -> Column:
    """Array of (name, body); text before the first marker and empty sections are dropped."""
    names = F.regexp_extract_all(text, F.lit(_SECTION), 1)
    bodies = F.split(text, _SECTION, -1)
    pairs = let(
        bodies,
        lambda b: F.transform(
            names,
            lambda n, i: F.struct(strip(n).alias("name"), F.get(b, i + 1).alias("body")),
        ),
    )
    return F.filter(pairs, lambda s: (s["name"] != "") & has_text(s["body"]))


def section_hash(section: Column) -> Column:
    """Hash of a section's name and body."""
    return short_hash(F.concat(section["name"], F.lit("\n"), section["body"]))


def report_hash(hashes: Column) -> Column:
    """Hash of a report: of the hashes of its sections, in order.

    Equal for texts that differ only in what no section shows, e.g. what stands before the
    first marker.
    """
    return short_hash(F.array_join(hashes, ""))


def doc_section_hashes(docs: DataFrame, keys: Sequence[str] = ("code",), text: str = "text") -> DataFrame:
    """(keys, section_no, name, section_hash, report_hash) of every section."""
    hashed = F.transform(sections_of(F.col(text)), lambda s: F.struct(s["name"].alias("name"), section_hash(s).alias("h")))
    made = docs.select(*keys, let(hashed, lambda a: F.struct(a.alias("s"), report_hash(F.transform(a, lambda x: x["h"])).alias("report_hash"))).alias("r"))
    rows = made.select(*keys, "r.report_hash", F.posexplode("r.s").alias("i", "s"))
    return rows.select(*keys, (F.col("i") + 1).alias("section_no"), "s.name", F.col("s.h").alias("section_hash"), "report_hash")


def doc_changed_sections(
    docs: DataFrame, known: DataFrame, code: str = "code", text: str = "text"
) -> DataFrame:
    """(code, section_no, name, body) of the sections whose (code, section_hash) is not in ``known``.

    A body that moved to another place of its report, or that another date's report had, is known.
    """
    cut = F.transform(sections_of(F.col(text)), lambda s: F.struct(s["name"].alias("name"), s["body"].alias("body"), section_hash(s).alias("h")))
    rows = docs.select(code, F.posexplode(cut).alias("i", "s")).select(code, (F.col("i") + 1).alias("section_no"), "s.*")
    fresh = rows.join(known.select(code, F.col("section_hash").alias("h")), [code, "h"], "left_anti")
    return fresh.select(code, "section_no", "name", "body")


def doc_sections(docs: DataFrame, keys: Sequence[str] = ("code",), text: str = "text") -> DataFrame:
    """(keys, section_no, name, body), numbered from 1."""
    return docs.select(*keys, F.posexplode(sections_of(F.col(text))).alias("i", "s")).select(
        *keys, (F.col("i") + 1).alias("section_no"), "s.name", "s.body"
    )


def header_name(body: Column) -> Column:
    return F.regexp_extract(body, r"◇[0-9]+[" + SPACE + r"]+([^" + SPACE + r"]+)", 1)


def header_date(body: Column) -> Column:
    return F.regexp_extract(body, r"更新日期[：:][" + SPACE + r"]*(\d{4}-\d{2}-\d{2})", 1)


def doc_header(sections: DataFrame, keys: Sequence[str] = ("code",)) -> DataFrame:
    """Instrument name and update date, from the first section of each document."""
    return sections.filter("section_no = 1").select(
        *keys, header_name(F.col("body")).alias("name"),
        header_date(F.col("body")).try_cast("date").alias("updated"),
    )


# ---- blocks ---------------------------------------------------------------------


def blocks_of(body: Column) -> Column:
    """Array of (kind, lines) of one section. Title and star lines at the top go."""
    body = F.regexp_replace(body, r"\A\n+", "")
    body = F.regexp_replace(body, r"\A[^\n]*◇[^\n]*(?:\n|\z)", "")
    body = F.regexp_replace(body, rf"\A{_GAP}★[^\n]*(?:\n|\z)", "")
    return F.transform(F.regexp_extract_all(body, F.lit(_BLOCK), 0), _block)


def _block(raw: Column) -> Column:
    kind = (
        F.when(raw.rlike(rf"\A{_HEADING}"), "heading")
        .when(raw.rlike(rf"\A{_DISCLAIMER}"), "disclaimer")
        .when(raw.rlike(rf"\A{_TABLE}"), "table")
        .when(raw.rlike(rf"\A{_ANNOUNCEMENT}"), "announcement")
        .when(raw.rlike(_DASHES), "dash_table")
        .otherwise("paragraph")
    )
    lines = F.transform(F.split(raw, "\n", -1), strip)
    return F.struct(kind.alias("kind"), lines.alias("lines"))


def doc_blocks(sections: DataFrame, keys: Sequence[str] = ("code",)) -> DataFrame:
    """(keys, section_no, block_no, kind, lines) of every section."""
    return sections.select(
        *keys, "section_no", F.posexplode(blocks_of(F.col("body"))).alias("i", "b")
    ).select(*keys, "section_no", (F.col("i") + 1).alias("block_no"), "b.kind", "b.lines")


# ---- box tables -----------------------------------------------------------------


def _starts(line: Column, *marks: str) -> Column:
    return F.substring(line, 1, 1).isin(*marks)


def _line_cells(line: Column) -> Column:
    """Cells between the bars, without the empty strings outside the outer bars."""

    def outer(cells: Column) -> Column:
        first = F.array_position(cells, "")
        inner = F.when(
            F.element_at(cells, -1) == "", F.slice(cells, F.lit(1), F.size(cells) - 1)
        ).otherwise(cells)
        framed = (first == 1) | (first == F.size(cells))
        return F.when(framed, F.filter(cells, lambda c: c != "")).otherwise(inner)

    return let(F.split(line, "│", -1), outer)


def _table_lines(lines: Column) -> Column:
    """Data lines as (cells, head); lines before the first inner rule are the head."""

    def rows(rule: Column) -> Column:
        data = F.transform(
            lines,
            lambda l, i: F.struct(
                F.when(
                    F.contains(l, F.lit("│")) & ~_starts(l, "┌", "└", "├"), _line_cells(l)
                ).alias("cells"),
                ((rule == 0) | (i + 1 < rule)).alias("head"),
            ),
        )
        return F.filter(data, lambda r: F.size(r["cells"]) > 0)

    first_rule = F.array_position(F.transform(lines, lambda l: _starts(l, "├", "└")), True)
    return let(first_rule, rows)


def _blank(text: Column) -> Column:
    return strip(text) == ""


def _label_only(cells: Column) -> Column:
    return F.forall(F.slice(cells, F.lit(2), F.size(cells)), _blank)


def _continues(row: Column, above: Column) -> Column:
    """A wrapped line: as wide as the line above, with either no label or only a label."""
    cells = row["cells"]
    return (F.size(cells) == F.size(above["cells"])) & (
        _blank(F.get(cells, F.lit(0))) | _label_only(cells)
    )


def _joined(group: Column) -> Column:
    """Cells of one logical row: its lines concatenated column by column."""
    head = F.get(group, F.lit(0))["cells"]

    def piece(row: Column, line: Column, col: Column) -> Column:
        label_wrap = (line > 0) & (col > 0) & ~_blank(F.get(row["cells"], F.lit(0)))
        return F.when(label_wrap, "").otherwise(F.get(row["cells"], col))

    return F.transform(
        head,
        lambda _, col: F.array_join(
            F.transform(group, lambda row, line: piece(row, line, col)), ""
        ),
    )


def table_rows_of(lines: Column) -> Column:
    """Array of (is_header, is_span, cells, width) of a box table.

    Cells are trimmed and rows padded to the widest. A body row of a wide table with
    exactly two filled cells is a label with one spanning value.
    """

    def grouped(rows: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(rows) - 1),
            lambda i: (i == 0) | ~_continues(F.get(rows, i), F.get(rows, i - 1)),
        )
        return let(
            first,
            lambda s: F.transform(
                s,
                lambda at, k: let(
                    F.slice(rows, at + 1, F.coalesce(F.get(s, k + 1), F.size(rows)) - at),
                    lambda group: F.struct(
                        _joined(group).alias("cells"),
                        ((k == 0) & F.get(group, F.lit(0))["head"]).alias("head"),
                    ),
                ),
            ),
        )

    def finished(rows: Column) -> Column:
        width = F.array_max(F.transform(rows, lambda r: F.size(r["cells"])))
        return let(width, lambda w: F.transform(rows, lambda r: _finish(r, w)))

    return let(
        _table_lines(lines),
        lambda rows: F.when(F.size(rows) > 0, let(grouped(rows), finished)).otherwise(
            F.array().cast("array<struct<is_header:boolean,is_span:boolean,cells:array<string>,width:int>>")
        ),
    )


def _finish(row: Column, width: Column) -> Column:
    cells, head = row["cells"], row["head"]
    filled = F.size(F.filter(cells, lambda c: ~_blank(c)))
    span = ~head & (width > 2) & (filled == 2)
    label = _unmarked(F.get(cells, F.lit(0)))
    value = strip(F.array_join(F.slice(cells, F.lit(2), F.size(cells)), ""))
    padded = F.concat(cells, F.array_repeat(F.lit(""), width - F.size(cells)))
    plain = F.transform(padded, lambda c: F.when(head, _unmarked(c)).otherwise(strip(c)))
    return F.struct(
        head.alias("is_header"), span.alias("is_span"),
        F.when(span, F.array(label, value)).otherwise(plain).alias("cells"),
        width.alias("width"),
    )


def _unmarked(text: Column) -> Column:
    """Trimmed, without the bullet marks header cells carry (fixed values)."""
    return F.regexp_replace(strip(text), r"\A[●★☆◆◇■□]+", "")


def doc_table_rows(blocks: DataFrame, keys: Sequence[str] = ("code",)) -> DataFrame:
    """(keys, section_no, block_no, row_no, is_header, is_span, cells) of all box tables."""
    place = [*keys, "section_no", "block_no"]
    return (
        blocks.filter("kind = 'table'")
        .select(*place, F.posexplode(table_rows_of(F.col("lines"))).alias("i", "r"))
        .select(*place, (F.col("i") + 1).alias("row_no"), "r.is_header", "r.is_span", "r.cells")
    )


# ---- announcements and dash tables ----------------------------------------------


def announcements_of(lines: Column) -> Column:
    """Array of (date, title, body) from the frames of an announcement block.

    A frame opens with a ruled line holding a tee downwards; up to the ruled line with a
    tee upwards the last 'date│title' line counts, after it every line is body.
    """

    def ruled(line: Column, tee: str) -> Column:
        return _starts(line, "─") & F.contains(line, F.lit(tee))

    def frame(part: Column) -> Column:
        close = F.array_position(F.transform(part, lambda l: ruled(l, "┴")), True)
        top = F.when(close > 0, F.slice(part, F.lit(1), close.cast("int") - 1)).otherwise(part)
        titles = F.filter(top, lambda l: F.contains(l, F.lit("│")) & ~_starts(l, "│"))
        rest = F.when(
            close > 0, F.slice(part, close.cast("int") + 1, F.size(part))
        ).otherwise(F.array().cast("array<string>"))
        body = F.filter(rest, lambda l: (l != "") & ~ruled(l, "┴"))
        return let(
            F.coalesce(F.get(titles, F.size(titles) - 1), F.lit("")),
            lambda t: F.struct(
                strip(F.substring_index(t, "│", 1)).alias("date"),
                strip(F.regexp_replace(t, r"\A[^│]*│?", "")).alias("title"),
                strip(F.array_join(body, "\n")).alias("body"),
            ),
        )

    opens = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ruled(F.get(lines, i), "┬")
    )
    frames = let(
        opens,
        lambda o: F.transform(
            o,
            lambda at, k: let(
                F.slice(lines, at + 2, F.coalesce(F.get(o, k + 1), F.size(lines)) - at - 1),
                frame,
            ),
        ),
    )
    return F.filter(frames, lambda a: a["title"] != "")


def doc_announcements(blocks: DataFrame, keys: Sequence[str] = ("code",)) -> DataFrame:
    """(keys, section_no, block_no, item_no, date, title, body) of all announcements."""
    place = [*keys, "section_no", "block_no"]
    return (
        blocks.filter("kind = 'announcement'")
        .select(*place, F.posexplode(announcements_of(F.col("lines"))).alias("i", "a"))
        .select(*place, (F.col("i") + 1).alias("item_no"), "a.date", "a.title", "a.body")
    )


def dash_table_of(lines: Column) -> Column:
    """(intro, pre_text): the text above the first dashed line, and all below it verbatim.

    Later dashed lines become empty lines, so the groups they separate stay apart.
    """
    dashed = lambda l: l.rlike(r"\A─{5,}\z")
    return let(
        F.array_position(F.transform(lines, dashed), True).cast("int"),
        lambda at: F.struct(
            F.array_join(F.slice(lines, F.lit(1), at - 1), "\n").alias("intro"),
            F.regexp_replace(
                F.array_join(
                    F.transform(
                        F.slice(lines, at + 1, F.size(lines)),
                        lambda l: F.when(dashed(l), "").otherwise(l),
                    ),
                    "\n",
                ),
                f"[{SPACE}]+\\z", "",
            ).alias("pre_text"),
        ),
    )


def doc_dash_table(blocks: DataFrame, keys: Sequence[str] = ("code",)) -> DataFrame:
    """(keys, section_no, block_no, intro, pre_text) of all dash tables."""
    place = [*keys, "section_no", "block_no"]
    return (
        blocks.filter("kind = 'dash_table'")
        .select(*place, dash_table_of(F.col("lines")).alias("d"))
        .select(*place, "d.intro", "d.pre_text")
    )


# ---- HTML -----------------------------------------------------------------------

CSS = """\
body { font-family: sans-serif; margin: 2em; color: #333; }
nav { position: sticky; top: 0; background: #fff; }
table { border-collapse: collapse; }
th, td { border: 1px solid #ccc; padding: 4px 8px; }
.announcement .body, p.content { white-space: pre-wrap; }
.disclaimer { color: #999; }
"""


def _tag(name: str, content: Column, attrs: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{attrs}>"), content, F.lit(f"</{name}>"))


def _table_html(lines: Column) -> Column:
    def cell(text: Column) -> Column:
        empty = (text == "") | (text == "---")
        return F.when(empty, '<td class="empty">-</td>').otherwise(_tag("td", escape(text)))

    def table(rows: Column) -> Column:
        def one(r: Column, i: Column) -> Column:
            cells = r["cells"]
            head = F.concat(
                F.lit("<thead><tr>\n"),
                F.array_join(F.transform(cells, lambda c: _tag("th", escape(c))), "\n"),
                F.lit("\n</tr></thead><tbody>"),
            )
            span = F.concat(
                F.lit("<tr>\n"), _tag("th", escape(F.get(cells, F.lit(0)))),
                F.lit('\n<td colspan="'), (r["width"] - 1).cast("string"), F.lit('">'),
                escape(F.get(cells, F.lit(1))), F.lit("</td>\n</tr>"),
            )
            plain = F.concat(
                F.lit("<tr>\n"), F.array_join(F.transform(cells, cell), "\n"), F.lit("\n</tr>")
            )
            body = F.when(r["is_span"], span).otherwise(plain)
            opened = F.when(i == 0, F.concat(F.lit("<tbody>\n"), body)).otherwise(body)
            return F.when(r["is_header"], head).otherwise(opened)

        page = F.concat(
            F.lit("<table>\n"), F.array_join(F.transform(rows, one), "\n"),
            F.lit("\n</tbody></table>"),
        )
        return F.when(F.size(rows) > 0, page).otherwise("")

    return let(table_rows_of(lines), table)


def _announcement_html(lines: Column) -> Column:
    return F.array_join(
        F.transform(
            announcements_of(lines),
            lambda a: _tag(
                "div",
                F.concat(
                    _tag("span", escape(a["date"]), ' class="date"'),
                    _tag("span", escape(a["title"]), ' class="title"'),
                    _tag("div", doc_escape_link(a["body"]), ' class="body"'),
                ),
                ' class="announcement"',
            ),
        ),
        "\n",
    )


def _dash_html(lines: Column) -> Column:
    def parts(d: Column) -> Column:
        intro = _tag("p", doc_escape_link(d["intro"]), ' class="content"')
        pre = _tag("pre", doc_escape_link(d["pre_text"]), ' class="dash-table"')
        return F.array_join(
            F.array(F.when(d["intro"] != "", intro), F.when(d["pre_text"] != "", pre)), "\n"
        )

    return let(dash_table_of(lines), parts)


def block_html(block: Column) -> Column:
    kind, lines = block["kind"], block["lines"]
    return (
        F.when(kind == "heading", _tag("h2", escape(F.get(lines, F.lit(0)))))
        .when(kind == "disclaimer",
              _tag("div", escape(F.array_join(lines, " ")), ' class="disclaimer"'))
        .when(kind == "table", _table_html(lines))
        .when(kind == "announcement", _announcement_html(lines))
        .when(kind == "dash_table", _dash_html(lines))
        .otherwise(_tag("p", doc_escape_link(F.array_join(lines, "\n")), ' class="content"'))
    )


def _section_html(section: Column) -> Column:
    name = escape(section["name"])
    return F.concat(
        F.lit('<section id="'), name, F.lit('">\n'), _tag("h1", name), F.lit("\n"),
        F.array_join(F.transform(blocks_of(section["body"]), block_html), "\n"),
        F.lit("\n</section>"),
    )


def _rendered(sections: Column, known: Column | None) -> Column:
    """Array of (name, section_hash, html), one per section.

    Sections whose hash is a key of the map ``known`` are taken from there; the others are parsed.
    """
    def one(section: Column) -> Column:
        digest = section_hash(section)
        html = _section_html(section)
        if known is not None:
            html = F.coalesce(F.try_element_at(known, digest), html)
        return F.struct(section["name"].alias("name"), digest.alias("section_hash"), html.alias("html"))

    return F.transform(sections, one)


def _page(sections: Column, body: Column, code: Column, css: str) -> Column:
    """One page out of rendered sections: navigation, then the sections. The tags are fixed values.

    ``body`` is the text of the first section, which names the company.
    """
    links = F.transform(
        sections,
        lambda s: F.concat(
            F.lit('<a href="#'), escape(s["name"]), F.lit('">'), escape(s["name"]), F.lit("</a>")
        ),
    )
    nav = F.concat(F.lit("<nav>\n"), F.array_join(links, "\n"), F.lit("\n</nav>"))
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html>\n<head>\n<meta charset="utf-8">\n<title>'),
        code, F.lit(" "), F.coalesce(header_name(body), F.lit("")),
        F.lit(f" F10</title>\n<style>{css}</style>\n</head>\n<body>\n"),
        F.when(F.size(sections) > 0, nav).otherwise(""), F.lit("\n"),
        F.array_join(F.transform(sections, lambda s: s["html"]), "\n"),
        F.lit("\n</body>\n</html>\n"),
    )


def render(text: Column, code: Column, css: str = CSS, known: Column | None = None) -> Column:
    """A report as (html, sections), its page and the rendered sections that make it up."""
    def report(sections: Column) -> Column:
        body = F.get(sections, F.lit(0))["body"]
        return let(
            _rendered(sections, known),
            lambda made: F.struct(_page(made, body, code, css).alias("html"), made.alias("sections")),
        )

    return let(sections_of(text), report)


def doc_render_html(
    docs: DataFrame, code: str = "code", text: str = "text", css: str = CSS
) -> DataFrame:
    """Documents with their HTML; the text column is replaced by ``html``."""
    return docs.withColumn("html", render(F.col(text), F.col(code), css)["html"]).drop(text)


def doc_render_sections(
    docs: DataFrame, known: DataFrame | None = None, code: str = "code", text: str = "text", css: str = CSS
) -> DataFrame:
    """Documents with their HTML and ``sections``; those sections that are known aren't parsed.

    ``known`` (code, section_hash, html) holds sections rendered before. A report has a small
    number of sections, so those of its code are one map beside it.
    """
    if known is None:
        made = docs.withColumn("__r", render(F.col(text), F.col(code), css))
    else:
        own = known.join(docs.select(code).distinct(), code, "left_semi").groupBy(code, "section_hash").agg(F.max("html").alias("html"))
        maps = own.groupBy(code).agg(F.map_from_entries(F.collect_list(F.struct("section_hash", "html"))).alias("__known"))
        none = F.expr("map()").cast("map<string,string>")
        held = docs.join(maps, code, "left").withColumn("__known", F.coalesce("__known", none))
        made = held.withColumn("__r", render(F.col(text), F.col(code), css, F.col("__known"))).drop("__known")
    return made.select(*[c for c in docs.columns if c != text], "__r.html", "__r.sections")
