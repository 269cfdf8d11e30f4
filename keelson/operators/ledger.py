"""Ledgers that refuse what the account cannot pay.

A redemption above the balance at that moment does not happen, so the balance
is no prefix sum: what a later row may take depends on which earlier ones
were refused.  As a function of the balance it starts with, a stretch of
rows is piecewise ``b + offset``: a credit adds to all offsets, a debit cuts
the piece in which it begins to be payable.  ``folds`` splits a hot account
into stretches.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.folds import fold_scan

#: Pieces that a stretch's function may have.
MOST_PIECES = 4096


class Stretch:
    """Balance after a stretch of rows as a function of the balance before:
    piece i holds from ``low[i]`` on and adds ``add[i]``."""

    def __init__(self) -> None:
        self.low, self.add = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def apply(self, amount: int) -> None:
        if amount >= 0:
            self.add = self.add + amount
            return
        need = -amount
        # within a piece the debit is payable from low + (need - balance at low) on
        from_ = need - self.add
        ends = np.append(self.low[1:], np.iinfo(np.int64).max)
        cut = (from_ > self.low) & (from_ < ends)
        pays = from_ <= self.low
        low = np.concatenate([self.low, from_[cut]])
        add = np.concatenate([np.where(pays, self.add - need, self.add), self.add[cut] - need])
        order = np.argsort(low, kind="stable")
        low, add = low[order], add[order]
        keep = np.append(True, add[1:] != add[:-1])     # neighbours with one offset are one piece
        self.low, self.add = low[keep], add[keep]

    def after(self, balance: int) -> int:
        return balance + int(self.add[np.searchsorted(self.low, balance, "right") - 1])


class Refusing:
    """The machine of a balance that never falls below zero."""

    first = 0

    def __init__(self, most: int) -> None:
        self.most = most

    def step(self, state: int, value: int) -> tuple[bool, int]:
        ok = value >= 0 or state + value >= 0
        return ok, state + value if ok else state

    def nothing(self) -> Stretch:
        return Stretch()

    def then(self, function: Stretch, value: int) -> Stretch | None:
        function.apply(value)
        return function if len(function.low) <= self.most else None

    def pack(self, function: Stretch) -> list[int]:
        return [*function.low.tolist(), *function.add.tolist()]

    def after(self, packed: list[int], state: int) -> int:
        f, half = Stretch(), len(packed) // 2
        f.low, f.add = np.array(packed[:half], np.int64), np.array(packed[half:], np.int64)
        return f.after(state)


def settle(ledger: DataFrame, account: str, order: Sequence[str], signed: Column, scale: int = 2,
           num_partitions: int | None = None) -> DataFrame:
    """The rows of ``ledger`` with ``accepted`` (false: a debit above the
    balance, which changes nothing) and ``balance`` (after the row).

    Accounts begin at zero; rows go by ``order``, which must be total per
    account.  ``signed`` is the amount, credits positive; null counts as
    zero.  Amounts are exact at ``scale`` digits.  Null accounts are one
    account.
    """
    unit = F.coalesce(F.round(signed.cast("decimal(38,6)") * F.lit(10 ** scale)).cast("long"), F.lit(0).cast("long"))
    done = fold_scan(ledger, account, order, unit, Refusing(MOST_PIECES), num_partitions)
    money = (F.col("state").cast("decimal(20,0)") / F.lit(10 ** scale)).cast(f"decimal(18,{scale})")
    return done.select("row.*", "accepted", money.alias("balance"))
