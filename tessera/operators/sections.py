"""Sections of cleaned filings, and overlapping word chunks of them. Everything runs inside a row: no shuffle.

Java counts UTF-16 units in ``regexp_instr`` and code points in ``substring``, so positions are taken as the length of the text
before the first match. ``(?d)`` makes only \\n a line end, ``(?U)`` makes classes Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import form_key, strip, words

_SEP = r"[\.\-:\s]+"
# Section headings by form, in order; the first match of each pattern is a marker.
SECTION_PATTERNS = {
    "10-K": (
        ("business", rf"^\s*item\s+1{_SEP}business\b"), ("risk_factors", rf"^\s*item\s+1A{_SEP}risk\s+factors\b"),
        ("mda", rf"^\s*item\s+7{_SEP}management'?s?\s+discussion"), ("mda", rf"^\s*item\s+7{_SEP}md&a"),
    ),
    "10-Q": (
        ("financial_statements", rf"^\s*item\s+1{_SEP}financial\s+statements\b"), ("mda", rf"^\s*item\s+2{_SEP}management'?s?\s+discussion"),
        ("mda", rf"^\s*item\s+2{_SEP}md&a"), ("risk_factors", rf"^\s*item\s+1A{_SEP}risk\s+factors\b"),
    ),
    "DEF 14A": (
        ("executive_compensation", r"^\s*executive\s+compensation\b"), ("executive_compensation", r"^\s*compensation\s+discussion"),
        ("corporate_governance", r"^\s*corporate\s+governance\b"), ("corporate_governance", r"^\s*board\s+of\s+directors\b"),
        ("security_ownership", r"^\s*security\s+ownership\b"), ("security_ownership", r"^\s*beneficial\s+ownership\b"),
    ),
}
ITEM_8K = r"^\s*item\s+[0-9]{1,2}\.[0-9]{2}\b"
# Which sections are chunked first.
SECTION_PRIORITY = {
    "risk_factors": 1, "mda": 2, "business": 3, "financial_statements": 4, "executive_compensation": 5, "corporate_governance": 6, "security_ownership": 7, "full_document_fallback": 99,
}
OTHER_PRIORITY = 50
SECTION_CHARS, ITEM_CHARS, PARAGRAPH_CHARS, FALLBACK_PARAGRAPHS = 300, 200, 250, 20


def _marker(text: Column, name: str, pattern: str, order: int) -> Column:
    """struct(at, order, name) of the first match, null where there is none."""
    flagged = f"(?imdU){pattern}"
    before = F.length(F.regexp_extract(text, rf"(?imdU)\A([\s\S]*?)(?={pattern})", 1))
    return F.when(text.rlike(flagged), F.struct(before.alias("at"), F.lit(order).alias("order"), F.lit(name).alias("name")))


def _section(name: Column, rank: Column, mode: str, text: Column) -> Column:
    return F.struct(name.alias("section_name"), rank.cast("int").alias("section_rank"), F.lit(mode).alias("source_mode"), text.alias("text"))


def heading_sections(text: Column, patterns: tuple) -> Column:
    """Sections between the markers of a form; ranks count markers whose section is too short as well."""
    found = F.array_sort(F.array_compact(F.array(*(_marker(text, n, p, k) for k, (n, p) in enumerate(patterns)))))
    # The same place and name twice is one marker.
    markers = F.filter(found, lambda m, k: (k == 0) | (F.get(found, k - 1)["at"] != m["at"]) | (F.get(found, k - 1)["name"] != m["name"]))
    cut = F.transform(
        markers,
        lambda m, k: _section(m["name"], k + 1, "regex_item", strip(F.substring(text, m["at"] + 1, F.coalesce(F.get(markers, k + 1)["at"], F.length(text)) - m["at"]))),
    )
    return F.filter(cut, lambda s: F.length(s["text"]) >= SECTION_CHARS)


def item_sections(text: Column) -> Column:
    """Sections of every ``item d.dd`` heading of an 8-K."""
    pieces = F.transform(F.split(text, f"(?imdU)(?={ITEM_8K})"), lambda p: strip(p))
    own = F.filter(pieces, lambda p: p.rlike(f"(?imdU)\\A{ITEM_8K[1:]}"))
    number = lambda p: F.regexp_extract(p, r"(?iU)\Aitem\s+([0-9]{1,2}\.[0-9]{2})", 1)
    cut = F.transform(own, lambda p, k: _section(F.concat(F.lit("item_"), F.replace(number(p), F.lit("."), F.lit("_"))), k + 1, "regex_item", p))
    return F.filter(cut, lambda s: F.length(s["text"]) >= ITEM_CHARS)


def fallback_section(text: Column) -> Column:
    """The first long paragraphs as one section; none where there are none."""
    paragraphs = F.filter(F.transform(F.split(text, r"\n{2,}"), lambda p: strip(p)), lambda p: F.length(p) >= PARAGRAPH_CHARS)
    joined = F.array_join(F.slice(paragraphs, 1, FALLBACK_PARAGRAPHS), "\n\n")
    return F.when(F.size(paragraphs) > 0, F.array(_section(F.lit("full_document_fallback"), F.lit(1), "fallback", joined)))


def sections_of(form: Column, text: Column) -> Column:
    """All sections of a document by its form; null and empty texts have none."""
    t = F.coalesce(text, F.lit(""))
    f = form_key(form)
    own = F.when(f == "8-K", item_sections(t))
    for name, patterns in SECTION_PATTERNS.items():
        own = own.when(f == name, heading_sections(t, patterns))
    return F.when(F.size(F.coalesce(own, F.array())) > 0, own).otherwise(fallback_section(t))


def extract_sections(docs: DataFrame, keys: list[str], form: str = "form_type", text: str = "text") -> DataFrame:
    cut = docs.select(*keys, F.explode(sections_of(F.col(form), F.col(text))).alias("_s"))
    return cut.select(*keys, "_s.section_name", "_s.section_rank", "_s.source_mode", F.col("_s.text").alias("section_text"))


def chunk_words(text: Column, size: int = 350, overlap: int = 50) -> Column:
    """Windows of ``size`` words, each beginning ``overlap`` words before the end of the one before; short tails are left out."""
    w = words(text)
    step, least = max(1, size - overlap), max(50, size // 3)
    starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda k: F.slice(w, k + 1, F.lit(size)))
    return F.transform(F.filter(windows, lambda c: F.size(c) >= least), lambda c: F.struct(F.size(c).cast("bigint").alias("word_count"), F.array_join(c, " ").alias("chunk_text")))


def priority(name: Column) -> Column:
    table = F.create_map(*(x for n, p in SECTION_PRIORITY.items() for x in (F.lit(n), F.lit(p))))
    return F.coalesce(F.try_element_at(table, name), F.lit(OTHER_PRIORITY))


def top_sections(sections: DataFrame, doc: str = "doc_id", k: int = 3, min_chars: int = 500) -> DataFrame:
    """Per document the ``k`` most important sections, then those long enough; if none is, the most important one."""
    order = Window.partitionBy(doc).orderBy(priority(F.col("section_name")), "section_rank")  # one document's sections
    best = sections.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= k)
    long = F.length("section_text") >= min_chars
    marked = best.withColumn("_any", F.max(long.cast("int")).over(Window.partitionBy(doc)))
    return marked.filter(long | ((F.col("_any") == 0) & (F.col("_k") == 1))).withColumnRenamed("_k", "section_order").drop("_any")


def chunks(sections: DataFrame, doc: str = "doc_id", size: int = 350, overlap: int = 50, k: int = 3, min_chars: int = 500) -> DataFrame:
    """Chunks of the chosen sections, numbered per document from 0."""
    cut = top_sections(sections, doc, k, min_chars).select(doc, "section_name", "section_order", F.posexplode(chunk_words(F.col("section_text"), size, overlap)).alias("_at", "_c"))
    number = F.row_number().over(Window.partitionBy(doc).orderBy("section_order", "_at")) - 1
    return cut.select(doc, F.col("section_name").alias("source_name"), number.cast("bigint").alias("chunk_index"), "_c.word_count", "_c.chunk_text")


def whole_text_chunks(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 350, overlap: int = 50) -> DataFrame:
    """The older way: documents without a usable section are chunked whole."""
    cut = docs.select(doc, F.posexplode(chunk_words(F.col(text), size, overlap)).alias("_at", "_c"))
    return cut.select(doc, F.lit("full_document").alias("source_name"), F.col("_at").cast("bigint").alias("chunk_index"), "_c.word_count", "_c.chunk_text")


def chunks_or_whole(docs: DataFrame, sections: DataFrame, doc: str = "doc_id", text: str = "text", **kw: int) -> DataFrame:
    """Chunks of the sections, and of the whole text for documents that have no section."""
    size = {k: v for k, v in kw.items() if k in ("size", "overlap")}
    rest = docs.join(sections.select(doc).distinct(), doc, "left_anti")
    return chunks(sections, doc, **kw).unionByName(whole_text_chunks(rest, doc, text, **size))


def route(chunked: DataFrame, chosen: DataFrame, doc: str = "doc_id", flag: str = "is_balanced") -> DataFrame:
    """Chunks with 1 where their document is in the chosen set, so that one pass feeds both outputs."""
    keys = chosen.select(F.col(doc).alias("_d")).distinct()
    return chunked.join(keys, F.col(doc) == F.col("_d"), "left").withColumn(flag, F.col("_d").isNotNull().cast("int")).drop("_d")


def document_chunks(docs: DataFrame, keys: list[str], form: str = "form_type", text: str = "text", size: int = 350, overlap: int = 50, k: int = 3, min_chars: int = 500) -> DataFrame:
    """As :func:`extract_sections` and :func:`chunks` together, but inside each row: no text is shuffled.

    Use this where the sections are not needed as a table of their own.
    """
    ranked = F.array_sort(F.transform(sections_of(F.col(form), F.col(text)), lambda s: F.struct(priority(s["section_name"]).alias("p"), s["section_rank"].alias("r"), s.alias("s"))))
    best = docs.select(*keys, F.slice(ranked, 1, k).alias("_best"))
    chosen = best.select(*keys, "_best", F.filter("_best", lambda b: F.length(b["s"]["text"]) >= min_chars).alias("_long"))
    picked = chosen.select(*keys, F.when(F.size("_long") > 0, F.col("_long")).otherwise(F.slice("_best", 1, 1)).alias("_picked"))
    one = lambda b: F.transform(chunk_words(b["s"]["text"], size, overlap), lambda c: F.struct(b["s"]["section_name"].alias("source_name"), c["word_count"].alias("word_count"), c["chunk_text"].alias("chunk_text")))
    cut = picked.select(*keys, F.posexplode(F.flatten(F.transform("_picked", one))).alias("_at", "_c"))
    return cut.select(*keys, "_c.source_name", F.col("_at").cast("bigint").alias("chunk_index"), "_c.word_count", "_c.chunk_text")
