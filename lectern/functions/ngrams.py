"""Metric tokenisers and the F-measure, as native Column expressions.

N-grams are counted from the token arrays by an Arrow UDF (``lectern.operators.metrics.shared_grams``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import NON_WS_RUN, _col

# --- fixed values: must equal the metric library's tokenisers -----------------------
# ROUGE: lower-case, keep runs of ASCII letters and digits.
ROUGE_TOKEN = r"[a-z0-9]+"
# BLEU 13a: literal replacements, then four regex passes (pattern, replacement).
BLEU_LITERALS = [("<skipped>", ""), ("-\n", ""), ("\n", " "),
                 ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
BLEU_PASSES = [
    (r"([{-~\[-\x60 -&(-+:-@/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# ------------------------------------------------------------------------------------


def rouge_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(ROUGE_TOKEN), 0)


def bleu_tokens(c) -> Column:
    s = _col(c)
    for a, b in BLEU_LITERALS:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in BLEU_PASSES:
        s = F.regexp_replace(s, pat, rep)
    return F.regexp_extract_all(s, F.lit(NON_WS_RUN), 0)


def fmeasure(p, r) -> Column:
    return F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
