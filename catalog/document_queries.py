"""The document corpus job."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions import doc_escape_link
from barlake.operators import documents as docs

from .registry import joined, query

C = F.col
_HASH = "substr(sha256({}), 1, 16)"


@query("doc_assemble", f"SELECT code, {_HASH.format('text')} AS h, strlen(text) AS size FROM fx_docs")
def _(t):
    return docs.doc_assemble(t.fx_doc_parts()).select(
        "code", F.substring(F.sha2("text", 256), 1, 16).alias("h"), F.octet_length("text").cast("bigint").alias("size")
    )


@query("doc_hash", f"SELECT doc_id, strlen(text) AS file_size, {_HASH.format('text')} AS file_hash FROM documents")
def _(t):
    return docs.doc_hash(t.table("documents")).select("doc_id", "file_size", "file_hash")


@query("doc_changed", f"SELECT source AS code, doc_id FROM documents WHERE (source, {_HASH.format('text')}) NOT IN (SELECT source, {_HASH.format('text')} FROM documents JOIN labels USING (doc_id))")
def _(t):
    hashed = docs.doc_hash(t.table("documents").withColumnRenamed("source", "code"))
    known = hashed.join(t.table("labels").select("doc_id"), "doc_id", "left_semi")
    return docs.doc_changed(hashed, known).select("code", "doc_id")


@query("doc_sections", f"SELECT code, row_number() OVER (PARTITION BY code ORDER BY category) AS section_no, category AS name, {_HASH.format('trim(text, chr(10))')} AS h FROM fx_doc_parts WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''")
def _(t):
    out = docs.doc_sections(docs.doc_assemble(t.fx_doc_parts()))
    body = F.regexp_replace("body", r"\A\n+|\n+\z", "")
    return out.select("code", C("section_no").cast("bigint").alias("section_no"), "name", F.substring(F.sha2(body, 256), 1, 16).alias("h"))


def sections(t):
    return docs.doc_sections(t.fx_reports())


def blocks(t):
    return docs.doc_blocks(sections(t))


@query("doc_header", "SELECT code, replace(p_name, ' ', '_') AS name, CAST(printf('2024-01-%02d', p_size % 28 + 1) AS DATE) AS updated FROM fx_reports")
def _(t):
    return docs.doc_header(sections(t))


@query("doc_blocks", """SELECT code, u.b.s AS section_no, u.b.n AS block_no, u.b.k AS kind, u.b.c AS lines FROM fx_reports, (SELECT unnest([
 {'s': 1, 'n': 1, 'k': 'heading', 'c': 1}, {'s': 1, 'n': 2, 'k': 'table', 'c': 7}, {'s': 1, 'n': 3, 'k': 'paragraph', 'c': 2},
 {'s': 2, 'n': 1, 'k': 'announcement', 'c': 5}, {'s': 2, 'n': 2, 'k': 'dash_table', 'c': 5}, {'s': 2, 'n': 3, 'k': 'disclaimer', 'c': 2}]) AS b) u""")
def _(t):
    return blocks(t).withColumn("lines", F.size("lines"))


@query("doc_table_rows", """SELECT code, 1 AS section_no, 2 AS block_no, r AS row_no, r = 1 AS is_header, r = 3 AS is_span,
 CASE r WHEN 1 THEN 'item|value|note' WHEN 2 THEN 'brand|' || p_brand || ' more|--- x<y' ELSE 'size|' || p_size END AS cells FROM fx_reports, (SELECT unnest([1, 2, 3]) AS r)""")
def _(t):
    return docs.doc_table_rows(blocks(t)).withColumn("cells", joined("cells", "|"))


@query("doc_announcements", "SELECT code, 2 AS section_no, 1 AS block_no, 1 AS item_no, printf('2024-01-%02d 10:00', p_size % 28 + 1) AS date, p_type AS title, 'body of ' || p_name || chr(10) || 'second line' AS body FROM fx_reports")
def _(t):
    return docs.doc_announcements(blocks(t))


@query("doc_dash_table", "SELECT code, 2 AS section_no, 2 AS block_no, 'holders' AS intro, 'a  ' || p_size || chr(10) || chr(10) || 'b  2' AS pre_text FROM fx_reports")
def _(t):
    return docs.doc_dash_table(blocks(t))


@query("doc_escape_link", r"SELECT page_id, regexp_replace(replace(replace(replace(url || ' ' || html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '(https?://[^\s]+)', '<a class=" + '"ext" href="\\1" target="_blank">\\1</a>' + r"', 'g') AS html FROM pages")
def _(t):
    return t.table("pages").select("page_id", doc_escape_link(F.concat_ws(" ", "url", "html")).alias("html"))


_PAGE = """'<section id="profile">' || n || '<h1>profile</h1>' || n || '<h2>【1.facts】</h2>' || n || '<table>' || n || '<thead><tr>' || n || '<th>item</th>' || n || '<th>value</th>' || n || '<th>note</th>' || n || '</tr></thead><tbody>' || n
 || '<tr>' || n || '<td>brand</td>' || n || '<td>' || p_brand || ' more</td>' || n || '<td>--- x&lt;y</td>' || n || '</tr>' || n || '<tr>' || n || '<th>size</th>' || n || '<td colspan="2">' || p_size || '</td>' || n || '</tr>' || n || '</tbody></table>' || n
 || '<p class="content">about ' || p_name || n || 'see <a class="ext" href="https://example.org/a?b=1&amp;c=2" target="_blank">https://example.org/a?b=1&amp;c=2</a> now</p>' || n || '</section>' || n
 || '<section id="news">' || n || '<h1>news</h1>' || n || '<div class="announcement"><span class="date">' || printf('2024-01-%02d 10:00', p_size % 28 + 1) || '</span><span class="title">' || p_type || '</span><div class="body">body of ' || p_name || n || 'second line</div></div>' || n
 || '<p class="content">holders</p>' || n || '<pre class="dash-table">a  ' || p_size || n || n || 'b  2</pre>' || n || '<div class="disclaimer">免责条款：none at all</div>' || n || '</section>' || n || '</body>' || n || '</html>' || n"""


@query("doc_render_html", f"SELECT code, '<title>' || code || ' ' || replace(p_name, ' ', '_') || ' F10</title>' AS title, {_PAGE} AS body FROM (SELECT *, chr(10) AS n FROM fx_reports)")
def _(t):
    pages = docs.doc_render_html(t.fx_reports())
    return pages.select(
        "code", F.regexp_extract("html", "(<title>.*</title>)", 1).alias("title"),
        F.substring_index("html", "</nav>\n", -1).alias("body"),
    )


@query("doc_render_corpus", "SELECT code, count(*) AS sections, count(*) AS links, count(*) AS headings FROM fx_doc_parts WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '' GROUP BY code")
def _(t):
    # every part that isn't blank is a section with a heading, and a link to it
    pages = docs.doc_render_html(docs.doc_assemble(t.fx_doc_parts()))
    found = lambda mark: F.regexp_count("html", F.lit(mark)).cast("long")
    return pages.select("code", found('<section id="').alias("sections"), found('<a href="#').alias("links"), found("<h1>").alias("headings"))


_TITLE = "'=== ' || category || ' ===' || chr(10) || text"
_BODY = "chr(10) || text || CASE WHEN pos < n THEN chr(10) || chr(10) ELSE '' END"
_SECTION_HASHES = f"""SELECT code, pos AS section_no, category AS name, {_HASH.format("category || chr(10) || " + _BODY)} AS section_hash
 FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY category) AS pos, count(*) OVER (PARTITION BY code) AS n FROM fx_doc_parts WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '')"""


@query("doc_section_hashes", f"SELECT x.*, {_HASH.format('y.all_hashes')} AS report_hash FROM ({_SECTION_HASHES}) x JOIN (SELECT code, string_agg(section_hash, '' ORDER BY section_no) AS all_hashes FROM ({_SECTION_HASHES}) GROUP BY code) y USING (code)")
def _(t):
    return docs.doc_section_hashes(docs.doc_assemble(t.fx_doc_parts())).withColumn("section_no", C("section_no").cast("bigint"))


# one part of every fifth report is another text than before
@query("doc_changed_sections", f"SELECT code, section_no, name FROM ({_SECTION_HASHES}) WHERE section_no = 2 AND CAST(substr(code, 2) AS BIGINT) % 5 = 0")
def _(t):
    reports = docs.doc_assemble(t.fx_doc_parts())
    known = docs.doc_section_hashes(reports)
    changed = (C("section_no") == 2) & (F.substring("code", 2, 18).cast("bigint") % 5 == 0)
    known = known.withColumn("section_hash", F.when(changed, F.lit("other")).otherwise(C("section_hash")))
    out = docs.doc_changed_sections(reports, known)
    return out.select("code", C("section_no").cast("bigint").alias("section_no"), "name")
