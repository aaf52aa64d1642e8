"""Sample rows and the results expected from them."""

from __future__ import annotations

import datetime as dt

D = dt.date.fromisoformat
TS = dt.datetime.fromisoformat


def _customer(cid, email, phone, city, day):
    return (cid, email, phone, city, day, f"batch_{day.replace('-', '')}_0800", TS(f"{day} 08:00:00"))


CUSTOMER_COLUMNS = ("customer_id", "email", "phone", "city", "event_ts", "_load_id", "_load_ts")
CUSTOMERS = [
    _customer("101", "a@ex.com", "700", "Москва", "2024-01-01"),
    _customer("102", "c@ex.com", "701", "СПб", "2024-01-01"),
    _customer("101", "b@ex.com", "700", "Москва", "2024-05-16"),
    _customer("101", "b@ex.com", "700", "Санкт-Петербург", "2024-10-01"),
]
CUSTOMERS_INCREMENT = [
    _customer("101", "b@ex.com", "700", "Москва", "2024-11-01"),
    _customer("103", "d@ex.com", "702", "Казань", "2024-03-10"),
]
ORDERS = [("5001", "2024-01-10", "101"), ("5002", "2024-02-05", "102")]
ORDER_ITEMS = [
    ("1", "5001", "9001", "2", "100.00"),
    ("2", "5001", "9002", "1", "50.00"),
    ("3", "5002", "9001", "1", "100.00"),
]
PRODUCTS = [("9001", "Phone"), ("9002", "Case")]
PRICES = [
    ("9001", "2023-12-01", "2024-01-31", "100.00"),
    ("9001", "2024-02-01", None, "110.00"),
    ("9002", "2023-01-01", None, "50.00"),
]
STATUS_COLUMNS = ("customer_id", "status", "event_ts", "_load_id", "_load_ts")


def _status(cid, status, event, load):
    stamp = load.replace("-", "").replace(" ", "_").replace(":", "")[:13]
    return (cid, status, f"{event}:00", f"batch_{stamp}", TS(f"{load}:00"))


STATUS = [
    _status("101", "new", "2024-01-01 09:00", "2024-01-01 10:00"),
    _status("101", "active", "2024-02-15 10:30", "2024-02-15 11:00"),
    _status("101", "vip", "2024-05-10 11:00", "2024-05-10 12:00"),
    _status("101", "churned", "2024-09-01 12:15", "2024-09-01 13:00"),
    _status("102", "new", "2024-03-05 14:00", "2024-03-05 15:00"),
    _status("102", "active", "2024-04-01 09:45", "2024-04-01 10:00"),
    _status("102", "churned", "2024-04-20 16:20", "2024-04-20 17:00"),
    _status("103", "new", "2024-03-10 10:10", "2024-03-10 11:00"),
]
STATUS_INCREMENT = [
    _status("101", "active", "2024-11-15 09:00", "2024-11-15 10:00"),
    _status("102", "active", "2024-05-05 09:30", "2024-05-05 10:00"),
    _status("103", "active", "2024-03-20 12:00", "2024-03-20 13:00"),
    _status("104", "new", "2024-06-01 08:00", "2024-06-01 09:00"),
]

DIM_CUSTOMER = {
    (101, "a@ex.com", "Москва", "94f29747ed6bf0bb08351f1c4b3a21ce", D("2024-01-01"), D("2024-05-16")),
    (101, "b@ex.com", "Москва", "ad1abd114a5b2541cbe1e542ed7b2a71", D("2024-05-16"), D("2024-10-01")),
    (101, "b@ex.com", "Санкт-Петербург", "0c18bdee2c5d4c7ccd77e49745628a98", D("2024-10-01"), None),
    (102, "c@ex.com", "СПб", "d54d56bca80387d965e3ac2688d305cf", D("2024-01-01"), None),
}
DIM_CUSTOMER_AFTER = {
    *(r for r in DIM_CUSTOMER if r[2] != "Санкт-Петербург"),
    (101, "b@ex.com", "Санкт-Петербург", "0c18bdee2c5d4c7ccd77e49745628a98", D("2024-10-01"), D("2024-11-01")),
    (101, "b@ex.com", "Москва", "ad1abd114a5b2541cbe1e542ed7b2a71", D("2024-11-01"), None),
    (103, "d@ex.com", "Казань", "cc8ad0acb2c1bcb81e34a29b6801fe4e", D("2024-03-10"), None),
}
FACT_SALES = {
    (101, D("2024-01-01"), 9001, 20240110, 2, "200.00"),
    (101, D("2024-01-01"), 9002, 20240110, 1, "50.00"),
    (102, D("2024-01-01"), 9001, 20240205, 1, "100.00"),
}
MART_DAILY_SALES = {
    (D("2024-01-10"), "Phone", "Premium", 2, "200.00"),
    (D("2024-01-10"), "Case", "Basic", 1, "50.00"),
    (D("2024-02-05"), "Phone", "Basic", 1, "100.00"),
}
MART_CUSTOMER_360 = {
    (101, D("2024-01-10"), D("2024-01-10"), 2, 3, "250.00", "b@ex.com", "Санкт-Петербург"),
    (102, D("2024-02-05"), D("2024-02-05"), 1, 1, "100.00", "c@ex.com", "СПб"),
}
DIM_STATUS = {
    (101, "new", D("2024-01-01"), D("2024-02-15")),
    (101, "active", D("2024-02-15"), D("2024-05-10")),
    (101, "vip", D("2024-05-10"), D("2024-09-01")),
    (101, "churned", D("2024-09-01"), None),
    (102, "new", D("2024-03-05"), D("2024-04-01")),
    (102, "active", D("2024-04-01"), D("2024-04-20")),
    (102, "churned", D("2024-04-20"), None),
    (103, "new", D("2024-03-10"), None),
}
DIM_STATUS_AFTER = {
    *(r for r in DIM_STATUS if r[3] is not None),
    (101, "churned", D("2024-09-01"), D("2024-11-15")),
    (101, "active", D("2024-11-15"), None),
    (102, "churned", D("2024-04-20"), D("2024-05-05")),
    (102, "active", D("2024-05-05"), None),
    (103, "new", D("2024-03-10"), D("2024-03-20")),
    (103, "active", D("2024-03-20"), None),
    (104, "new", D("2024-06-01"), None),
}
STATUS_DAILY_SAMPLE = {
    (D("2024-01-15"), "new", 1),
    (D("2024-04-10"), "active", 3),
    (D("2024-09-15"), "active", 2),
    (D("2024-09-15"), "churned", 1),
    (D("2024-09-15"), "new", 1),
    (D("2024-12-01"), "active", 3),
    (D("2024-12-01"), "new", 1),
}
