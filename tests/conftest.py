from __future__ import annotations

import csv
import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardlake import contracts  # noqa: E402
from cardlake.session import local_session  # noqa: E402

NOW = datetime(2026, 8, 1, 12, 0, tzinfo=timezone.utc)

TRANSACTION_HEADER = contracts.TRANSACTIONS.fieldNames()
CARD_HEADER = contracts.CARDS.fieldNames()
USER_HEADER = contracts.USERS.fieldNames()


def payment(day, time, amount, method, merchant, place, error="", fraud="No", user=11, card=3):
    year, month, day_of_month = day.split("-")
    return [str(user), str(card), year, str(int(month)), str(int(day_of_month)), time, amount,
            f"{method} Transaction", str(merchant), *place, error, fraud]


BRNO = ["Brno", "JM", "60200.0", "5094"]
OSLO = ["Oslo", "OS", "150.0", "4111"]
FIRST_FILE = [
    payment("2023-11-29", "22:05", "$7.10", "Swipe", -4411, BRNO),
    payment("2023-12-01", "00:00", "$1,310.99", "Chip", 9000000000000000001, OSLO, "Bad PIN", user=12),
    payment("2023-12-01", "9:30", "$-3.25", "Online", 9000000000000000001, OSLO, fraud="Yes"),
]
SECOND_FILE = [
    payment("2023-12-02", "17:45", "$64.00", "Chip", 52, ["Porto", "PT", "4000.0", "5733"], user=13),
    payment("2023-12-03", "6:01", "$0.50", "Swipe", -4411, BRNO, "Insufficient Balance", user=12),
]
CARDS = [
    ["11", "3", "Amex", "Credit", "370000000000017", "03/2031", "1907", "NO", "1", "$700",
     "11/2011", "2019", "No"],
    ["12", "0", "Discover", "Debit", "6011000000000094", "10/2027", "018", "YES", "3", "$0",
     "05/2005", "2021", "Yes"],
]
USERS = [
    ["Ada Novak", "61", "67", "1964", "12", "Female", "7 Hill Lane", "3.0", "Brno", "JM",
     "60200", "49.1951", "16.6068", "$18,400", "$31,050", "$0", "801", "1"],
    ["Per Dahl", "29", "70", "1996", "2", "Male", "18 Quay Road", "44.0", "Oslo", "OS",
     "150", "59.9139", "10.7522", "$51,900", "$48,300", "$96,001", "640", "5"],
]


def write_csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as stream:
        writer = csv.writer(stream)
        writer.writerow(header)
        writer.writerows(rows)
    return path


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "cardlake-tests")


@pytest.fixture
def landing(tmp_path):
    """A root with all three landing domains filled."""
    write_csv(tmp_path / "landing/transactions/a.csv", TRANSACTION_HEADER, FIRST_FILE)
    write_csv(tmp_path / "landing/transactions/b.csv", TRANSACTION_HEADER, SECOND_FILE)
    write_csv(tmp_path / "landing/cards/cards.csv", CARD_HEADER, CARDS)
    write_csv(tmp_path / "landing/users/users.csv", USER_HEADER, USERS)
    return tmp_path


def rows(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
