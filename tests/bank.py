"""Tiny hand-written bank tables for boundary goldens."""

from datetime import date, datetime
from decimal import Decimal

from fraudlane.schemas import (ACCOUNTS, CARDS, CLIENTS, FACT_BLACKLIST, FACT_TRANSACTIONS,
                               TERMINALS)
from fraudlane.sources.bank_fixture import BankTables

START = datetime(2024, 1, 1)
END = datetime(9999, 12, 31)


def ts(text):
    return datetime.fromisoformat(text)


def tables(spark, transactions, clients=None, accounts=None, cards=None, terminals=None,
           blacklist=()):
    """transactions: (trans_id, 'YYYY-MM-DD HH:MM:SS', card, type, amount, result, terminal)."""
    tr = [(t, ts(d), c, ty, Decimal(str(a)), r, term) for t, d, c, ty, a, r, term in transactions]
    clients = clients or [("1", "Ivanov", "Ivan", "I", date(1980, 1, 1), "P1", date(2030, 1, 1), "+71")]
    accounts = accounts or [("A1", date(2030, 1, 1), "1")]
    cards = cards or [("C1", "A1"), ("C2", "A1")]
    terminals = terminals or [("T1", "POS", "Moscow", "a"), ("T2", "POS", "Kazan", "b"),
                              ("T3", "ATM", "Moscow", "c")]
    scd = (START, END, "N")
    return BankTables(
        fact_transactions=spark.createDataFrame(tr, FACT_TRANSACTIONS),
        fact_passport_blacklist=spark.createDataFrame([(p, date(2024, 1, 1)) for p in blacklist], FACT_BLACKLIST),
        dim_terminals_hist=spark.createDataFrame([t + scd for t in terminals], TERMINALS.history_schema()),
        dim_cards_hist=spark.createDataFrame([c + scd for c in cards], CARDS.history_schema()),
        dim_accounts_hist=spark.createDataFrame([a + scd for a in accounts], ACCOUNTS.history_schema()),
        dim_clients_hist=spark.createDataFrame(
            [(c[0], c[1], c[2], c[3], c[5], c[6], c[7], c[4]) + scd for c in clients],
            CLIENTS.history_schema()),
    )
