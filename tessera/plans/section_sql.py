"""SQL that cuts sections independently of the operators (regular expressions without lookaround)."""

from __future__ import annotations

from tessera.operators.sections import SECTION_PATTERNS

# Unicode white space for an engine whose \\s is ASCII.
_SPACES = "\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_SP = f"[{_SPACES}]"
_ITEM = f"(?im)^{_SP}*item{_SP}+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SP}+|{_SP}+$', '', 'g')"


def _pattern(p: str) -> str:
    """Everything before the first match of a heading, as group 1."""
    one, many = "[\\.\\-:\\s]", "\0"
    return "(?ims)\\A(.*?)" + p.replace(one, many).replace("\\s", _SP).replace(many, f"[.\\-:{_SPACES}]")


_VALUES = ", ".join(f"({_quoted(form)}, {k}, {_quoted(name)}, {_quoted(_pattern(p))})" for form, ps in SECTION_PATTERNS.items() for k, (name, p) in enumerate(ps))

#: Ends with a table ``a`` of doc_id, form_type, section_name, section_rank, source_mode and the text s.
SECTIONS = f"""WITH p(form, k, name, pattern) AS (VALUES {_VALUES}), d AS (SELECT doc_id, upper({strip("coalesce(document_type, '')")}) AS form_type, coalesce(text, '') AS t FROM documents),
  m0 AS (SELECT doc_id, form_type, t, name, k, length(regexp_extract(t, pattern, 1)) AS pos FROM d JOIN p ON p.form = d.form_type WHERE regexp_matches(t, pattern)),
  m1 AS (SELECT doc_id, form_type, t, name, pos, min(k) AS k FROM m0 GROUP BY ALL),
  m2 AS (SELECT *, row_number() OVER w AS section_rank, lead(pos) OVER w AS next FROM m1 WINDOW w AS (PARTITION BY doc_id ORDER BY pos, k)),
  heads AS (SELECT doc_id, form_type, name AS section_name, section_rank, {strip("substr(t, pos + 1, coalesce(next, length(t)) - pos)")} AS s, 300 AS least FROM m2),
  i0 AS (SELECT doc_id, form_type, regexp_extract_all(t, '{_ITEM}([0-9]{{1,2}}\\.[0-9]{{2}})\\b', 1) AS n, regexp_extract_all(t, '{_ITEM}[0-9]{{1,2}}\\.[0-9]{{2}}\\b') AS h,
    regexp_split_to_array(t, '{_ITEM}[0-9]{{1,2}}\\.[0-9]{{2}}\\b') AS b FROM d WHERE form_type = '8-K'),
  items AS (SELECT doc_id, form_type, 'item_' || replace(n[j], '.', '_') AS section_name, j AS section_rank, {strip("h[j] || b[j + 1]")} AS s, 200 AS least FROM (SELECT *, unnest(range(1, len(n) + 1)) AS j FROM i0)),
  own AS (SELECT * FROM heads WHERE length(s) >= least UNION ALL SELECT * FROM items WHERE length(s) >= least),
  f AS (SELECT doc_id, form_type, list_filter(list_transform(regexp_split_to_array(t, '\\n{{2,}}'), lambda x: {strip('x')}), lambda x: length(x) >= 250)[1:20] AS ps FROM d WHERE doc_id NOT IN (SELECT doc_id FROM own)),
  a AS (SELECT doc_id, form_type, section_name, section_rank, 'regex_item' AS source_mode, s FROM own UNION ALL SELECT doc_id, form_type, 'full_document_fallback', 1, 'fallback', array_to_string(ps, chr(10) || chr(10)) FROM f WHERE len(ps) > 0)"""
