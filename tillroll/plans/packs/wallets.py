"""Rules for payment services and wallets."""

from __future__ import annotations

from tillroll.plans.packs.common import ANY_YEAR, COMMA_MINUTES, DAY, MONTH_DAY_SECONDS, NO_TEXT
from tillroll.plans.rule import (
    Rule,
    cell,
    cell_find,
    const,
    contains_folded,
    equals,
    find,
    first,
    if_says,
    says_folded,
)

# Senders, titles, labels and patterns of the receipts.

# -- GoTagihan: known by the sender alone; amounts sit in the second HTML table
GOTAGIHAN = Rule(
    provider="gotagihan",
    variant="receipt",
    title=None,
    sender=equals("receipts@gotagihan.gojek.com"),
    cells=True,
    money="M4",
    dates=COMMA_MINUTES,
    raw_currency=True,
    blank=NO_TEXT,
    texts={
        "trx_id": find(r"(?:Payment ID|ID Pembayaran) - (.+-GOBILLS)"),
        "date": first(
            cell_find(0, 0, 1, r"(\d{1,2} \w+ \d{4}, \d{1,2}:\d{2})"),
            find(r"(\d{2} \w+ \d{4}, \d{2}:\d{2})"),
        ),
        "merchant": cell(1, 0, 1),
        "amount": cell_find(1, 0, 2, r"^[^0-9]*([0-9].*)$"),
        "currency": cell_find(1, 0, 2, r"^([^0-9]*)[0-9]"),
        "payment_method": const("GoPay"),
        "description": const(""),
    },
)

# -- OVO
OVO = Rule(
    provider="ovo",
    variant="receipt",
    title=equals("OVO QR Payment Receipt"),
    sender=equals("noreply@ovo.co.id"),
    flat=True,
    money="M3",
    fee_money="M1",
    dates=ANY_YEAR,
    texts={
        "trx_id": find(r"No\. Resi \(Kode Transaksi\)\s*(\S+)"),
        "date": find(r"(\d{2}\s[A-Za-z]{3}\s\d{2,4}(?:,\s\d{2}:\d{2}(?::\d{2})?)?)"),
        "merchant": find(r"Nama Toko\s*([^\n]+?)\s+Lokasi"),
        "amount": find(r"Pembayaran\s*Rp(\d{1,3}(?:\.\d{3})*)"),
        "fees": find(r"Tip\s*Rp([\d,]+)"),
        "currency": const("IDR"),
        "payment_method": if_says("OVO Cash", const("OVO Cash"), const("OVO Points")),
        "description": const("OVO"),
    },
)

# -- PayPal: three layouts in two languages
_PAYPAL = dict(
    provider="paypal",
    title=contains_folded(
        "anda mengirim pembayaran",
        "anda telah menerima",
        "you've received",
        "you sent a payment",
        "you have received",
        "receipt for your payment",
    ),
    sender=contains_folded("service@intl.paypal.com"),
    nullable=frozenset({"trx_id"}),
    blank=NO_TEXT,
)
_PAYPAL_DATE = find(
    r"(?:Tanggal transaksi|Transaction date)\s*\n\s*(.+?)"
    r"(?:\s+\d{2}\.\d{2}\.\d{2}\s+(?:WIB|WITA|WIT))?[ \t\r]*(?=\n|$)"
)
_PAYPAL_SHARED = {
    "trx_id": find(r"(?:ID transaksi|Transaction ID)\s*(\S+)"),
    "date": _PAYPAL_DATE,
    "merchant": find(r"Merchant\s*\n(.*)\n", default="Paypal"),
    "payment_method": const("Paypal"),
}
_PAYPAL_NOTE = find(r"(?s)(?:CATATAN ANDA UNTUK|YOUR NOTES FOR).*?\n\s*\n\s*(.+?)\n")
_PAYPAL_SENT = (
    r"You paid\s*[$€£]?([\d,.]+)[\s$€£]*(\w+)",
    r"Payment\s*[$€£]?([\d,.]+)[\s$€£]*(\w+)",
    r"Anda membayar\s*[$€£]?([\d,.]+)[\s$€£]*(\w+)",
)
_PAYPAL_TOTAL = r"Total\s*[€£$]?\s*([\d,.]+)\s*[€£$]?\s*(\w+)"
_PAYPAL_RECEIVED = r"(?:Jumlah yang diterima|Amount received)\s*[$€]([\d.,]*\d)\s*(\w+)"
PAYPAL = (
    Rule(
        **_PAYPAL,
        variant="sent",
        when=says_folded("anda mengirim", "you sent"),
        money="M5",
        dates=(*DAY, *MONTH_DAY_SECONDS),
        texts={
            **_PAYPAL_SHARED,
            "amount": find(*_PAYPAL_SENT, group=1),
            "currency": find(*_PAYPAL_SENT, group=2),
            "description": _PAYPAL_NOTE,
        },
    ),
    Rule(
        **_PAYPAL,
        variant="received",
        when=says_folded("anda menerima", "has sent you"),
        money="M7",
        dates=DAY,
        incoming=True,
        texts={
            **_PAYPAL_SHARED,
            "amount": find(_PAYPAL_RECEIVED, group=1),
            "currency": find(_PAYPAL_RECEIVED, group=2),
            "description": find(r"(?s)(?:CATATAN|NOTED).*?\n\s*\n\s*(.+?)\n"),
        },
    ),
    Rule(
        **_PAYPAL,
        variant="payment",
        when=says_folded("pembayaran anda", "you paid"),
        money="M5",
        dates=DAY,
        texts={
            **_PAYPAL_SHARED,
            "amount": find(_PAYPAL_TOTAL, group=1),
            "currency": find(_PAYPAL_TOTAL, group=2),
            "description": _PAYPAL_NOTE,
        },
    ),
)

RULES = (GOTAGIHAN, OVO, *PAYPAL)
