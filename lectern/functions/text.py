"""Text expressions (cleaning, sentence split, token counts, templates).

Every function returns a ``Column`` built from JVM-side built-ins, so the whole
cleaner runs inside whole-stage codegen with no Python in the path.  The regex
constants are plain strings shared with the SQL oracle (``lectern.plans.oracle``);
all character classes are spelled out explicitly so Java regex and RE2 agree.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the reference's for right results -------------------
# Licence preamble removed from landed books (lazy, dot-all; the eight lines in order).
PREAMBLE_LINES = [
    r"The Project Gutenberg eBook of .*?\n",
    r"This ebook is for the use of anyone anywhere in the United States and\n",
    r"most other parts of the world at no cost and with almost no restrictions\n",
    r"whatsoever. You may copy it, give it away or re-use it under the terms\n",
    r"of the Project Gutenberg License included with this ebook or online\n",
    r"at www\.gutenberg\.org. If you are not located in the United States,\n",
    r"you will have to check the laws of the country where you are located\n",
    r"before using this eBook\.\n",
]
# Handles and web addresses removed after the preamble.
# An address ends at any Unicode white space: separators and the control spaces.
HANDLE_URL = r"@[\p{L}\p{N}_]+|https?://[^\p{Z}\t\n\r\f\x0B\x1C-\x1F\x85]+"
# Prompt template: question first, then the context.
PROMPT_PREFIX = "Provide a detailed summary of the following content based on the question '"
PROMPT_MIDDLE = "': "
# Answer enrichment separator.
CONTEXT_SEPARATOR = "\n\nContext: "
# Separator between retrieved passages.
PASSAGE_SEPARATOR = "\n\n"
# ------------------------------------------------------------------------------------

PREAMBLE = "(?s)" + "".join(PREAMBLE_LINES)
NEWLINES = r"\r\n?"
WS = r"[ \t\n\r\f]"
NON_WS_RUN = r"[^ \t\n\r\f]+"
# sentence end: terminal punctuation, optional closing quotes/brackets, then whitespace
SENTENCE_END = r"""([.!?]['")\]]*)[ \t\n\r\f]+"""
TRIM = r"^[ \t\n\r\f]+|[ \t\n\r\f]+$"
MARK = "\u0001"
# a mark that is in the text itself is written otherwise until the pieces are cut
ESCAPES = [("\u0002", "\u0002\u0003"), ("\u0001", "\u0002\u0004")]


def normalize_newlines(c) -> Column:
    """text-mode reading turns CRLF and lone CR into LF."""
    return F.regexp_replace(_col(c), NEWLINES, "\n")


def strip_preamble(c) -> Column:
    """remove every licence preamble block, title line included."""
    return F.regexp_replace(_col(c), PREAMBLE, "")


def strip_handles_urls(c) -> Column:
    """remove ``@handle`` (Unicode word chars) and ``http(s)://...``."""
    return F.regexp_replace(_col(c), HANDLE_URL, "")


def trim_ws(c) -> Column:
    return F.regexp_replace(_col(c), TRIM, "")


def sentence_end(abbreviations: list[str] | None = None) -> str:
    """Boundary pattern; ``abbreviations`` (e.g. ["Mr", "Dr"]) never end a sentence.

    The option uses a Java look-behind, so it has no RE2 (SQL oracle) spelling; the
    default (no list) is what the registered queries use."""
    if not abbreviations:
        return SENTENCE_END
    alts = "|".join(sorted((re.escape(a) for a in abbreviations), key=len, reverse=True))
    # not preceded by an abbreviation that is itself not preceded by a letter/digit
    return r"(?<!(?<![\p{L}\p{N}])(?:" + alts + r"))" + SENTENCE_END


def sentences(c, abbreviations: list[str] | None = None) -> Column:
    """rule-based sentence split -> ARRAY<STRING> (blank pieces dropped)."""
    text = _col(c)
    for a, b in ESCAPES:
        text = F.replace(text, F.lit(a), F.lit(b))
    parts = F.split(F.regexp_replace(text, sentence_end(abbreviations), "$1" + MARK), MARK)

    def piece(s):
        s = F.regexp_replace(s, TRIM, "")
        for a, b in reversed(ESCAPES):
            s = F.replace(s, F.lit(b), F.lit(a))
        return s
    return F.filter(F.transform(parts, piece), lambda s: F.length(s) > 0)


def join_sentences(arr) -> Column:
    """re-join sentences with one space."""
    return F.array_join(_col(arr), " ")


def clean_text(c) -> Column:
    """F1 -> F2 -> F3 -> F4 -> F5 as one expression."""
    return join_sentences(sentences(strip_handles_urls(strip_preamble(normalize_newlines(c)))))


def clean_sentences(c) -> Column:
    """Sentences of the cleaned text (re-splitting cleaned text gives the same list)."""
    return sentences(strip_handles_urls(strip_preamble(normalize_newlines(c))))


def token_count(c) -> Column:
    """whitespace token count (default counter)."""
    return F.regexp_count(_col(c), F.lit(NON_WS_RUN))


def ws_tokens(c) -> Column:
    """Whitespace tokens as an array."""
    return F.regexp_extract_all(_col(c), F.lit(NON_WS_RUN), 0)


def sentence_lengths(arr) -> Column:
    return F.transform(_col(arr), lambda s: F.regexp_count(s, F.lit(NON_WS_RUN)))


def chunk_file_name(stem, chunk_no) -> Column:
    """F8: ``{stem}_chunk_{i}.txt``."""
    return F.format_string("%s_chunk_%d.txt", _col(stem), _col(chunk_no))


def book_file_name(book_id) -> Column:
    return F.format_string("book_id_%d.txt", _col(book_id))


def prompt(question, context) -> Column:
    """question first, then the context."""
    return F.concat(F.lit(PROMPT_PREFIX), _col(question), F.lit(PROMPT_MIDDLE), _col(context))


def truncate_tokens(c, n: int) -> Column:
    """R6 on text: first ``n`` whitespace tokens, re-joined with one space."""
    return F.array_join(F.slice(ws_tokens(c), 1, n), " ")


def enrich(summary, context) -> Column:
    """``summary + "\\n\\nContext: " + context``."""
    return F.concat(_col(summary), F.lit(CONTEXT_SEPARATOR), _col(context))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
