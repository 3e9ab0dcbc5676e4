"""DuckDB SQL of the licence scan, from the same fixed sentences and rules."""

from erpweave.llm.licenses import HINT, RULES, SENTENCES


def _ids(text: str) -> str:
    low = "translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    norm = f"trim(regexp_replace({low}, '[^a-z0-9]+', ' ', 'g'))"
    cut = rf"string_split(regexp_replace({text}, '([.!?;:])\s+', '\1' || chr(10), 'g'), chr(10))"
    known = "MAP {" + ", ".join(f"'{s}': '{n}'" for n, s in SENTENCES.items()) + "}"
    return f"[x FOR x IN [{known}[{norm}] FOR s IN {cut}] IF x IS NOT NULL]"


def _held(chain: tuple[str, ...]) -> str:
    return f"(contains(a, '|{'|'.join(chain)}|') OR contains(b, '|{'|'.join(chain)}|'))"


_HINTED = f"CASE WHEN regexp_matches(coalesce(text, ''), '{HINT}') THEN text ELSE '' END"
_LICENCES = ", ".join(f"CASE WHEN {_held(c)} THEN '{n}' END" for n, c in RULES)
_COVERAGE = ", ".join(f"CASE WHEN {_held(c)} THEN {len(c)} ELSE 0 END" for _, c in RULES)

SQL = rf"""
WITH h AS (SELECT doc_id, {_HINTED} AS t FROM documents),
f AS (SELECT doc_id, {_ids("t")} AS lines, {_ids(r"regexp_replace(t, '\s*\n\s*', ' ', 'g')")} AS joined FROM h),
c AS (SELECT doc_id, CASE WHEN len(joined) > len(lines) THEN joined ELSE lines END AS ids,
             '|' || array_to_string(lines, '|') || '|' AS a, '|' || array_to_string(joined, '|') || '|' AS b FROM f)
SELECT doc_id,
       array_to_string(list_sort(list_distinct([x FOR x IN [{_LICENCES}] IF x IS NOT NULL])), ',') AS licenses,
       len(ids)::BIGINT AS n_sentences,
       greatest({_COVERAGE})::BIGINT AS coverage,
       array_to_string(ids, ',') AS identifiers
FROM c
"""
