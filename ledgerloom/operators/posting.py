"""Posting: debit/credit rules, journal lines and the balancing line.

A journal is a list of :class:`LineSpec`. All lines that read the same frame
are summed in one pass: a row is hashed once, by all labels any line kind
uses, into one conditional sum per kind, with a map-side combine, down to a
handful of rows per day. Only these are stacked into one arm per line kind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.keys import MONEY, POSTING, ci_key
from ledgerloom.functions.scalars import batch_id, mmddyyyy
from ledgerloom.operators.aggregates import sum_by_label
from ledgerloom.operators.joins import account_lookup

# Journal header constants.
TRANTYPE = "5"
SRCDOC = "ACL"
CURRID = "Z-US$"

LABELS = ["txn_type", "business_line", "settled_by", "tax_type", "currency", "flag"]
LINE_COLUMNS = [
    "business_date", "company", "checkbookid", "batchid", "trantype", "trandate", "srcdoc", "currid", "reference",
    "account", "debit", "credit", "distref", "key1", "reversedate", "uniqueid", "table_name",
]


# --- debit / credit rules --------------------------------------------------

def debit_credit(amount: Column | str, rule: str) -> tuple[Column, Column]:
    """Debit and credit of an amount.

    CN posts a positive amount as credit, DN as debit; both leave NULL as NULL.
    CN0 and DN0 post NULL as zero.
    """
    x = F.col(amount) if isinstance(amount, str) else amount
    zero = F.lit(0)
    up = F.when(x < 0, zero).otherwise(x)
    down = F.when(x > 0, zero).otherwise(-x)
    up0 = F.when(x > 0, x).otherwise(zero)
    down0 = F.when(x < 0, -x).otherwise(zero)
    sides = {"CN": (down, up), "DN": (up, down), "CN0": (down0, up0), "DN0": (up0, down0)}
    debit, credit = sides[rule]
    return debit.cast(MONEY), credit.cast(MONEY)


def post(df: DataFrame, amount: str, rule: str) -> DataFrame:
    debit, credit = debit_credit(amount, rule)
    return df.withColumns({"debit": debit, "credit": credit})


def post_mirrored(df: DataFrame, amount: str, rule: str, keep: Sequence[str]) -> DataFrame:
    """The amount posted, and once more with its sides swapped; ``side`` tells them apart."""
    debit, credit = debit_credit(amount, rule)
    arms = F.array(
        F.struct(F.lit("line").alias("side"), debit.alias("debit"), credit.alias("credit")),
        F.struct(F.lit("mirror").alias("side"), credit.alias("debit"), debit.alias("credit")),
    )
    return df.select(*keep, F.inline(arms))


# --- line specifications ---------------------------------------------------

Builder = Callable[[], Column]


@dataclass(frozen=True)
class LineSpec:
    """One kind of journal line.

    ``where`` keeps rows before summing, ``having`` keeps sums. ``gated`` keeps
    the day's lines of this kind only when any of them is not zero. ``matrix``
    names the account-matrix keys; otherwise ``account`` builds the account.
    """

    name: str
    amount: str
    keys: tuple[str, ...]
    rule: str
    distref: Builder
    account: Builder | None = None
    matrix: tuple[str, ...] = ()
    where: Builder | None = None
    having: Builder | None = None
    gated: bool = False
    uniqueid_prefix: str | None = None


@dataclass(frozen=True)
class JournalSpec:
    """Values common to a journal's lines."""

    name: str
    checkbook: str
    reference: str
    uniqueid_prefix: str
    account_default: str
    repeat_date: bool = False
    lines: tuple[LineSpec, ...] = field(default_factory=tuple)

    def line(self, *names: str) -> tuple[LineSpec, ...]:
        return tuple(s for s in self.lines if s.name in names)


def summarise_lines(df: DataFrame, specs: Sequence[LineSpec]) -> DataFrame:
    """Sum every line kind of one frame in a single grouped pass.

    Rows no kind wants are dropped before, where every kind says which it
    wants. A group of no rows of a kind is no line; one whose amounts are all
    NULL is a line of NULL.
    """
    used = [k for k in LABELS if any(k in s.keys for s in specs)]
    wanted = {s.name: F.coalesce(s.where(), F.lit(False)) for s in specs if s.where}
    if len(wanted) == len(specs):
        df = df.filter(reduce(lambda a, b: a | b, wanted.values()))
    measures = []
    for s in specs:
        amount = F.col(s.amount).cast(POSTING)
        measures.append(F.sum(F.when(wanted[s.name], amount) if s.where else amount).alias(f"__sum_{s.name}"))
        measures.append(F.count(F.when(wanted[s.name], 1) if s.where else F.lit(1)).alias(f"__n_{s.name}"))
    few = df.groupBy("business_date", "company", *used).agg(*measures)
    arms = [
        F.struct(
            F.lit(s.name).alias("line"),
            *[(F.col(k) if k in s.keys else F.lit(None)).cast("string").alias(k) for k in LABELS],
            F.col(f"__sum_{s.name}").alias("amount"),
            (F.col(f"__n_{s.name}") > 0).alias("keep"),
        )
        for s in specs
    ]
    stacked = few.select("business_date", "company", F.inline(F.array(*arms))).filter("keep")
    sums = sum_by_label(stacked, ["business_date", "company", "line"], used, {"amount": "amount"})
    unused = {k: F.lit(None).cast("string") for k in LABELS if k not in used}
    return sums.withColumns(unused) if unused else sums


def _by_line(specs: Sequence[LineSpec], value: Callable[[LineSpec], Column]) -> Column:
    out = F.when(F.col("line") == specs[0].name, value(specs[0]))
    for s in specs[1:]:
        out = out.when(F.col("line") == s.name, value(s))
    return out


def header(journal: JournalSpec, date: str = "business_date") -> dict[str, Column]:
    """Header columns that do not depend on the line."""
    return {
        "checkbookid": F.lit(journal.checkbook),
        "batchid": batch_id(date),
        "trantype": F.lit(TRANTYPE),
        "trandate": mmddyyyy(date),
        "srcdoc": F.lit(SRCDOC),
        "currid": F.lit(CURRID),
        "reference": F.concat(mmddyyyy(date), F.lit(journal.reference)),
        "key1": F.lit(""),
        "reversedate": F.lit(""),
    }


def unique_id(prefix: str, repeat_date: bool, date: str = "business_date") -> Column:
    parts = [F.lit(prefix), mmddyyyy(date)] + ([mmddyyyy(date)] if repeat_date else [])
    return F.concat(F.col("company"), *parts)


def post_lines(sums: DataFrame, journal: JournalSpec, specs: Sequence[LineSpec], matrix: DataFrame | None = None):
    """Turn summed amounts into journal lines."""
    kept = _by_line(specs, lambda s: s.having() if s.having else F.lit(True))
    lines = sums.filter(kept)
    lookups = {s.matrix for s in specs if s.matrix}
    for keys in lookups:
        lines = account_lookup(lines, matrix, keys, default=journal.account_default, alias="__account")
    sides = {s.name: debit_credit("amount", s.rule) for s in specs}
    lines = lines.withColumns(
        {
            **header(journal),
            "account": _by_line(specs, lambda s: F.col("__account") if s.matrix else s.account()),
            "debit": _by_line(specs, lambda s: sides[s.name][0]),
            "credit": _by_line(specs, lambda s: sides[s.name][1]),
            "distref": _by_line(specs, lambda s: s.distref()),
            "uniqueid": _by_line(
                specs, lambda s: unique_id(s.uniqueid_prefix or journal.uniqueid_prefix, journal.repeat_date)
            ),
            "table_name": F.col("line"),
        }
    )
    if any(s.gated for s in specs):
        day = Window.partitionBy("business_date", "company", "line")
        moved = F.sum(F.col("debit") + F.col("credit")).over(day)
        gated = F.col("line").isin(*[s.name for s in specs if s.gated])
        lines = lines.withColumn("__moved", moved).filter(~gated | (F.col("__moved") > 0))
    return lines.select(*LINE_COLUMNS)


def build_lines(
    df: DataFrame, journal: JournalSpec, specs: Sequence[LineSpec], matrix: DataFrame | None = None
) -> DataFrame:
    return post_lines(summarise_lines(df, specs), journal, specs, matrix)


# --- balancing line, document amount, distribution type --------------------

BOOK = ["business_date", "company", "checkbookid"]


def branded() -> Column:
    """The label starts with the company; a NULL label does not."""
    return F.coalesce(F.upper("distref").startswith(ci_key("company")), F.lit(False))


def add_plug(lines: DataFrame, journal: JournalSpec, account: str | Column, label: str, name: str) -> DataFrame:
    """Append one balancing line per company, day and checkbook.

    The line is emitted next to the first line of its book, so the lines are
    computed once rather than a second time for their own total.
    """
    book = Window.partitionBy(*BOOK)
    gap = F.sum(F.when(branded(), F.col("credit") - F.col("debit"))).over(book).cast(MONEY)
    seen = F.count(F.when(branded(), 1)).over(book)
    first = F.row_number().over(book.orderBy("table_name", "distref"))
    marked = lines.withColumns({"__gap": gap, "__emit": (first == 1) & (seen > 0)})
    debit, credit = debit_credit("__gap", "DN0")
    fixed = {
        "account": F.lit(account),
        "debit": debit,
        "credit": credit,
        "distref": F.concat(F.col("company"), F.lit(label)),
        "uniqueid": unique_id(journal.uniqueid_prefix, journal.repeat_date),
        "table_name": F.lit(name),
    }
    rest = [c for c in LINE_COLUMNS if c not in BOOK]
    own = F.struct(*[F.col(c).alias(c) for c in rest])
    plug = F.struct(*[fixed.get(c, F.col(c)).cast(lines.schema[c].dataType).alias(c) for c in rest])
    arms = F.when(F.col("__emit"), F.array(own, plug)).otherwise(F.array(own))
    return marked.select(*BOOK, F.inline(arms)).select(*LINE_COLUMNS)


def add_document_amount(lines: DataFrame, of: Column, scope: Sequence[str] = ("business_date", "company")) -> DataFrame:
    """Debit less credit of the lines ``of`` selects, on every line of the journal."""
    book = Window.partitionBy(*scope)
    total = F.sum(F.when(of, F.col("debit") - F.col("credit"))).over(book)
    return lines.withColumn("docamt", total.cast(MONEY))


def add_distribution_type(lines: DataFrame, account: str | Column, when_equal: str, otherwise: str) -> DataFrame:
    same = F.col("account") == account
    return lines.withColumn("distype", F.when(same, when_equal).otherwise(otherwise))


def add_receipt(lines: DataFrame, prefix: Column, run_stamp: str) -> DataFrame:
    return lines.withColumn("cashrcpt", F.concat(prefix, F.lit(run_stamp)))
