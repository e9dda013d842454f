"""SQL (DuckDB dialect) spellings of the same rules, used by the oracle queries.

Each helper mirrors one Column builder from ``lectern.functions``; the regex constants
are imported, never retyped, so the two engines are checked against one definition.
The oracle is brute force on purpose (it may cross join or recurse); it only runs on
the small correctness scale.
"""

from __future__ import annotations

import re

from lectern.functions import ngrams as NG
from lectern.functions import text as TX
from lectern.functions import vectors as VX


def lit(s: str) -> str:
    """SQL string literal; control characters are spliced in with chr()."""
    parts, buf = [], []
    for ch in s:
        if ord(ch) < 32:
            if buf:
                parts.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not parts:
        parts.append("'" + "".join(buf).replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")" if len(parts) > 1 else parts[0]


def rep(java_replacement: str) -> str:
    """Java ``$1`` group references -> RE2 ``\\1``."""
    return lit(re.sub(r"\$(\d)", r"\\\1", java_replacement))


def rx_replace(x: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {rep(replacement)}, 'g')"


def normalize_newlines(x): return rx_replace(x, TX.NEWLINES, "\n")
def strip_preamble(x): return rx_replace(x, TX.PREAMBLE)
def strip_handles_urls(x): return rx_replace(x, TX.HANDLE_URL)


def sentences(x: str) -> str:
    for a, b in TX.ESCAPES:
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    marked = rx_replace(x, TX.SENTENCE_END, "$1" + TX.MARK)
    piece = rx_replace("s", TX.TRIM)
    for a, b in reversed(TX.ESCAPES):
        piece = f"replace({piece}, {lit(b)}, {lit(a)})"
    return (f"list_filter(list_transform(string_split({marked}, chr(1)), "
            f"lambda s: {piece}), lambda s: length(s) > 0)")


def clean_sentences(x: str) -> str:
    return sentences(strip_handles_urls(strip_preamble(normalize_newlines(x))))


def clean_text(x: str) -> str:
    return f"array_to_string({clean_sentences(x)}, ' ')"


def token_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(TX.NON_WS_RUN)}))"


def ws_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(TX.NON_WS_RUN)})"


def truncate_tokens(x: str, n: int) -> str:
    return f"array_to_string(list_slice({ws_tokens(x)}, 1, {n}), ' ')"


def prompt(q: str, ctx: str) -> str:
    return f"({lit(TX.PROMPT_PREFIX)} || {q} || {lit(TX.PROMPT_MIDDLE)} || {ctx})"


def enrich(summary: str, ctx: str) -> str:
    return f"({summary} || {lit(TX.CONTEXT_SEPARATOR)} || {ctx})"


def rouge_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {lit(NG.ROUGE_TOKEN)})"


def bleu_tokens(x: str) -> str:
    s = x
    for a, b in NG.BLEU_LITERALS:
        s = f"replace({s}, {lit(a)}, {lit(b)})"
    s = f"(' ' || {s} || ' ')"
    for pat, r in NG.BLEU_PASSES:
        s = rx_replace(s, pat, r)
    return f"regexp_extract_all({s}, {lit(TX.NON_WS_RUN)})"


def embed_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {lit(VX.EMBED_TOKEN)})"


# ----------------------------------------------------------------- CTE builders

def sentence_cte(name: str, src: str, key: str, text: str, cleaned: bool = False) -> str:
    """(doc_id, i 1-based, s, n) one row per sentence of the (cleaned) text."""
    lst = sentences(text) if cleaned else clean_sentences(text)
    return f"""{name} AS MATERIALIZED (
  SELECT doc_id, i::BIGINT AS i, s, {token_count('s')}::BIGINT AS n
  FROM (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i
        FROM (SELECT {key} AS doc_id, {lst} AS l FROM {src}))
)"""


def chunk_ctes(prefix: str, sents: str, budget: int) -> str:
    """Greedy packing as a recursive walk over sentence numbers.

    Produces ``{prefix}`` (doc_id, chunk_no, chunk_text, n_tokens, n_sentences)."""
    return f"""{prefix}_walk AS (
  SELECT doc_id, i, CASE WHEN n > {budget} THEN 1 ELSE 0 END AS cid, n AS cur FROM {sents} WHERE i = 1
  UNION ALL
  SELECT s.doc_id, s.i, w.cid + CASE WHEN w.cur + s.n > {budget} THEN 1 ELSE 0 END,
         CASE WHEN w.cur + s.n > {budget} THEN s.n ELSE w.cur + s.n END
  FROM {prefix}_walk w JOIN {sents} s ON s.doc_id = w.doc_id AND s.i = w.i + 1
),
{prefix} AS MATERIALIZED (
  SELECT w.doc_id, w.cid::BIGINT AS chunk_no, string_agg(s.s, ' ' ORDER BY s.i) AS chunk_text,
         sum(s.n)::BIGINT AS n_tokens, count(*)::BIGINT AS n_sentences
  FROM {prefix}_walk w JOIN {sents} s ON s.doc_id = w.doc_id AND s.i = w.i GROUP BY w.doc_id, w.cid
  UNION ALL
  SELECT doc_id, 0::BIGINT, '', 0::BIGINT, 0::BIGINT FROM {sents} WHERE i = 1 AND n > {budget}
)"""


def hash_ctes(prefix: str, src: str, key: str, text: str, dim: int) -> str:
    """Signed hashed counts -> ``{prefix}_cnt`` (key, b, c) and unit ``{prefix}`` (key, b, v)."""
    return f"""{prefix}_tok AS (
  SELECT k, md5(t) AS h FROM (SELECT {key} AS k, unnest({embed_tokens(text)}) AS t FROM {src})
),
{prefix}_cnt AS MATERIALIZED (
  SELECT k, (('0x' || substr(h, 1, 8))::BIGINT % {dim})::BIGINT AS b,
         sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS c
  FROM {prefix}_tok GROUP BY 1, 2 HAVING sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END) <> 0
),
{prefix}_dir AS (
  SELECT k, b, c FROM {prefix}_cnt
  UNION ALL
  SELECT k, (('0x' || substr(h, 1, 8))::BIGINT % {dim})::BIGINT, CASE WHEN substr(h, 9, 1) < '8' THEN 1.0 ELSE -1.0 END::DOUBLE
  FROM (SELECT {key} AS k, md5({text}) AS h FROM {src} WHERE length({text}) > 0) w
  WHERE NOT EXISTS (SELECT 1 FROM {prefix}_cnt n WHERE n.k = w.k)
),
{prefix} AS MATERIALIZED (
  SELECT k, b, c / sqrt(sum(c * c) OVER (PARTITION BY k)) AS v FROM {prefix}_dir
)"""


LABELLED = "doc_id IN (SELECT doc_id FROM labels)"


def catalogue_ctes(docs: str = "documents", labelled: str = LABELLED, p: str = "") -> str:
    """Derived catalogue (same rule as ``lectern.sources.tables.catalogue``) + first match."""
    return f"""{p}cat AS (
  SELECT doc_id AS id, 'Doc ' || doc_id::VARCHAR AS title, source AS author, lang AS context, 0 AS entry_dup
  FROM {docs} WHERE {labelled}
  UNION ALL
  SELECT doc_id, 'Doc ' || doc_id::VARCHAR || ' (second entry)', source, lang, 1
  FROM {docs} WHERE {labelled} AND doc_id % 7 = 0
),
{p}cat1 AS (SELECT * FROM {p}cat QUALIFY row_number() OVER (PARTITION BY id ORDER BY entry_dup) = 1)"""


def points_ctes(budget: int, dim: int, docs: str = "documents", labelled: str = LABELLED, p: str = "",
                sents: str | None = None) -> str:
    """Corpus build: sentences -> chunks -> matched books -> ids -> stored points.

    Yields ``{p}pts`` (id, book_id, chunk_no, chunk_text, title, author, context) and
    ``{p}pvec`` (k = id, b, vf) with components rounded through FLOAT like the store.
    ``sents`` reuses an existing sentence CTE instead of splitting again."""
    sent_cte = "" if sents else sentence_cte(f"{p}psents", docs, "doc_id", "text") + ",\n"
    sents = sents or f"{p}psents"
    return f"""{catalogue_ctes(docs, labelled, p)},
{sent_cte}{chunk_ctes(f'{p}pchunks', sents, budget)},
{p}nch AS (SELECT doc_id, max(chunk_no) + 1 AS n_chunks FROM {p}pchunks GROUP BY 1),
{p}books AS (
  SELECT n.doc_id, c.title, c.author, c.context,
         coalesce(sum(n.n_chunks) OVER (ORDER BY n.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM {p}nch n JOIN {p}cat1 c ON c.id = n.doc_id
),
{p}allpts AS MATERIALIZED (
  SELECT (b.off + k.chunk_no)::BIGINT AS id, k.doc_id AS book_id, k.chunk_no, k.chunk_text,
         b.title, b.author, b.context
  FROM {p}pchunks k JOIN {p}books b ON b.doc_id = k.doc_id
),
{hash_ctes(f'{p}pvec0', f'{p}allpts', 'id', 'chunk_text', dim)},
{p}pvec AS (SELECT k, b, v::FLOAT::DOUBLE AS vf FROM {p}pvec0),
{p}pts AS (SELECT * FROM {p}allpts WHERE id IN (SELECT k FROM {p}pvec))"""


def question_ctes() -> str:
    return """qs AS (
  SELECT item_id AS qid, text AS question,
         CASE WHEN item_id % 4 = 3 THEN NULL WHEN item_id % 4 = 2 THEN '' ELSE text END AS reference
  FROM benchmark
)"""


def topk_ctes(k: int, dim: int, questions: str = "qs", p: str = "", qvec: str | None = None) -> str:
    """Brute-force top-k of every question over every stored point -> ``{p}hits``
    (qid, rank, id, score, text).  ``qvec`` reuses an existing question-vector CTE."""
    qv_cte = "" if qvec else hash_ctes(f"{p}qvec", questions, "qid", "question", dim) + ",\n"
    qvec = qvec or f"{p}qvec"
    return f"""{qv_cte}{p}qdot AS (SELECT q.k AS qid, pv.k AS id, sum(q.v * pv.vf) AS s FROM {qvec} q JOIN {p}pvec pv ON pv.b = q.b GROUP BY 1, 2),
{p}qall AS (
  SELECT q.qid, pt.id, round(coalesce(d.s, 0.0), 9) AS score
  FROM (SELECT DISTINCT k AS qid FROM {qvec}) q CROSS JOIN (SELECT id FROM {p}pts) pt
  LEFT JOIN {p}qdot d ON d.qid = q.qid AND d.id = pt.id
),
{p}hits AS (
  SELECT r.qid, r.rank, r.id, r.score, coalesce(pt.chunk_text, '') AS text FROM (
    SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id ASC) AS rank FROM {p}qall
  ) r JOIN {p}pts pt ON pt.id = r.id WHERE r.rank <= {k}
)"""
