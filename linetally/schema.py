"""Column roles, fixed values and output column names.

Every operator takes its input column names from a :class:`LineColumns`
instance, so a table with other names needs no renaming step.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the behaviour being reproduced:
#   - the characters kept by the text cleaner, in this order:
#       aáãàâbcçdeéêfghiíjklmnoóôõpqrstuúüvwxyz_
#   - the category value that marks an uncategorised line: INDEFINIDO
#   - the separator between ids in an id list: |
#   - the share of distinct texts selected by the Pareto report: 0.2
#   - percentage bucket bounds (upper bound inclusive): 0, 25, 50, 75, 100
#   - day parts by hour: madrugada [0, 6), dia [6, 12), tarde [12, 18),
#     noite [18, 24) (see functions.buckets for the compatible variant)
# ---------------------------------------------------------------------------
ALLOWED_CHARACTERS = "aáãàâbcçdeéêfghiíjklmnoóôõpqrstuúüvwxyz_"
UNDEFINED_CATEGORY = "INDEFINIDO"
ID_SEPARATOR = "|"
PARETO_SHARE = 0.2
BUCKET_BOUNDS = (0, 25, 50, 75, 100)
MADRUGADA_HOURS = (0, 6)
DIA_HOURS = (6, 12)
TARDE_HOURS = (12, 18)
NOITE_START_HOUR = 18

# Width (in id units) of one chunk of an id list; see operators.idlists.
DEFAULT_ID_SPAN = 4096


@dataclass(frozen=True)
class LineColumns:
    """Names of the columns of a statement-lines table.

    ``row_id``, ``text``, ``amount`` and ``category`` are required by the
    profile (rows with a null in any of them are left out); the others are
    read only by the operators that need them.
    """

    row_id: str = "row_id"
    text: str = "text"
    amount: str = "amount"
    category: str = "category"
    category_pct: str = "category_pct"
    ts: str = "ts"
    user_id: str = "user_id"
    institution: str = "institution"
    #: How amounts are summed: ``double``, exactly and rounded once (functions.exact_sum), or, in a subclass,
    #: an exact type that every amount has to fit (functions.buckets.money).
    amount_type = "double"


PROFILE_COLUMNS = (
    "text",
    "count",
    "amount",
    "category",
    "percentual_count",
    "percentual_amount",
    "category_percentual_quartil",
    "count_dia",
    "count_tarde",
    "count_noite",
    "count_madrugada",
    "percentual_dia",
    "percentual_tarde",
    "percentual_noite",
    "percentual_madrugada",
)

TOTALS_COLUMNS = (
    "total_count",
    "total_amount",
    "undefined_count",
    "undefined_amount",
    "categorised_count",
    "categorised_amount",
    "unique_texts",
)
