"""Receipts rendered by Spark from the order tables.

The given tables hold no mail, so each order is written as the receipt one of the 35 layouts would
send: the layout is ``o_orderkey % 35`` and every value follows from the order and its customer.
Nothing is random. Faults are injected by key as well:

- ``% 17 = 0``: the amount is missing
- ``% 23 = 0``: the subject is unrelated
- ``% 13 = 0``: spaces are no-break spaces (written raw when the key is odd, else as an entity)
- ``% 19 = 0``: the message is sent twice
- ``% 2 = 0``: the sender carries a display name
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import INDONESIAN_MONTHS, INDONESIAN_SHORT_MONTHS, INDONESIAN_WEEKDAYS
from tillroll.functions.text import bind, extract_domain, parse_addr, switch
from tillroll.session import spread


def _swap(c: Column, mapping: dict[str, str]) -> Column:
    """English names to Indonesian ones."""
    back = {en: local for local, en in reversed(mapping.items())}
    lookup = F.create_map(*(F.lit(x) for pair in back.items() for x in pair))
    return lookup[c]


def orders_base(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with what its values are made from, dealt out after the join by the number of orders."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf}/{name}.parquet")

    # nation and region are fixed-size dimensions (25 and 5 rows)
    places = read("nation").join(
        F.broadcast(read("region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    orders = read("orders")
    base = (
        orders.join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    k = F.col("o_orderkey")
    return spread(
        base.select(
            k.alias("k"),
            F.floor("o_totalprice").alias("amount"),
            (F.col("o_orderdate") + F.make_dt_interval(secs=k * 37 % 86400)).alias("ts"),
            F.initcap("c_mktsegment").alias("segment"),
            F.concat_ws(" ", F.initcap("c_mktsegment"), F.initcap("r_name")).alias("merchant"),
        ),
        orders.count(),
    )


def _values(m: Column) -> dict[str, Column]:
    """Every value a template may print, of an order."""
    k, amount, t = m["k"], m["amount"], m["ts"]
    fee = (k % 5) * 500
    id = F.lpad(k.cast("string"), 12, "0")
    id17 = F.lpad(k.cast("string"), 17, "0")

    def dotted(c: Column) -> Column:
        return F.translate(F.format_number(c, 0), ",", ".")

    mon, month = F.date_format(t, "MMM"), F.date_format(t, "MMMM")
    bul = _swap(mon, INDONESIAN_SHORT_MONTHS)
    return {
        "merchant": m["merchant"],
        "segment": m["segment"],
        "number": k.cast("string"),
        "id": id,
        "id444": F.concat_ws(" ", F.substring(id, 1, 4), F.substring(id, 5, 4), F.substring(id, 9, 4)),
        "gpa": F.concat_ws("-", F.substring(id17, 1, 4), F.substring(id17, 5, 4), F.substring(id17, 9, 4), F.substring(id17, 13, 5)),
        "d": F.date_format(t, "dd"),
        "d1": F.date_format(t, "d"),
        "mon": mon,
        "month": month,
        "y": F.date_format(t, "yyyy"),
        "yy": F.date_format(t, "yy"),
        "hm": F.date_format(t, "HH:mm"),
        "hms": F.date_format(t, "HH:mm:ss"),
        "clock": F.lower(F.date_format(t, "h:mma")),
        "iso": F.date_format(t, "yyyy-MM-dd"),
        "dmy": F.date_format(t, "dd/MM/yyyy"),
        "mdy": F.date_format(t, "MM/dd/yyyy"),
        "weekday": F.date_format(t, "EEEE"),
        "bulan": _swap(month, INDONESIAN_MONTHS),
        "bul": bul,
        "hari": _swap(F.date_format(t, "EEEE"), INDONESIAN_WEEKDAYS),
        "play_mon": F.when(mon == "Sep", F.lit("Sept")).otherwise(mon),
        "itemku_mon": F.when(k % 3 == 0, bul).otherwise(mon),
        "plain": amount.cast("string"),
        "comma": F.format_number(amount, 0),
        "comma2": F.format_number(amount, 2),
        "dot": dotted(amount),
        "space": F.translate(F.format_number(amount, 0), ",", " "),
        "fee_plain": fee.cast("string"),
        "fee_comma": F.format_number(fee, 0),
        "fee_comma2": F.format_number(fee, 2),
        "fee_dot": dotted(fee),
        "fee_space": F.translate(F.format_number(fee, 0), ",", " "),
        # whole and decimal, grouped by either mark or not at all
        "usd": F.element_at(
            F.array(F.format_number(amount, 0), dotted(amount), F.format_number(amount, 2), F.concat(dotted(amount), F.lit(",00")),
                    F.concat(amount.cast("string"), F.lit(",00")), F.concat(amount.cast("string"), F.lit(".0"))),
            (F.floor(k / 35) % 6 + 1).cast("int"),
        ),
        "wallet": F.element_at(F.array(*map(F.lit, ("ShopeePay", "DANA", "GoPay", "OVO"))), (k % 4 + 1).cast("int")),
    }


def _row(*cells: str) -> str:
    return "<tr>" + " ".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def _rows(*pairs: tuple[str, ...]) -> str:
    """A table; a row whose first cell starts with ``?`` belongs to the optional amount."""
    out = []
    for cells in pairs:
        if cells[0].startswith("?"):
            out.append(f"<<{_row(cells[0][1:], *cells[1:])}>>")
        else:
            out.append(_row(*cells))
    return "<table>" + "".join(out) + "</table>"


def _lines(*pairs: tuple[str, str]) -> str:
    """A label paragraph followed by its value paragraph."""
    out = []
    for label, value in pairs:
        if label.startswith("?"):
            out.append(f"<<<p>{label[1:]}</p><p>{value}</p>>>")
        else:
            out.append(f"<p>{label}</p><p>{value}</p>")
    return "".join(out)


_BRI = "BankBRI@bri.co.id"
_LIVIN = "noreply.livin@bankmandiri.co.id"
_OCBC = "onlinetransaction@ocbc.id"
_PAYPAL = "service@intl.paypal.com"
_PAN = "9360001430019008"

# layout -> (provider, variant, sender, subject, body)
LAYOUTS: list[tuple[str, str, str, str, str]] = [
    (
        "mybca", "receipt", "bca@bca.co.id", "Internet Transaction Journal",
        _rows(
            ("Status", ":", "Successful"),
            ("Transaction Date", ":", "{d} {mon} {y} {hms}"),
            ("Beneficiary Name", ":", "{merchant}"),
            ("?Target Amount", ":", "IDR {comma2}"),
            ("Fee", ":", "IDR {fee_comma2}"),
            ("Remarks", ":", "Order {number}"),
            ("Reference No.", ":", "C{id}"),
        ),
    ),
    (
        "bri", "ewallet", _BRI, "Top Up",
        "<p>{d} {bulan} {y}, {hms} WIB</p>"
        + _rows(
            ("No. Ref", "{id}"),
            ("Jenis Transaksi", "{wallet}"),
            ("Catatan", "-"),
            ("?Nominal", "Rp{dot}"),
            ("Biaya Admin", "Rp{fee_dot}"),
        ),
    ),
    (
        "bri", "briva", _BRI, "Pembayaran",
        "<p>{d} {bulan} {y}, {hm} WIB</p>"
        + _rows(
            ("No. Ref", "{id}"),
            ("Tujuan", "TOKO A1", "{merchant}", "1234567890123456"),
            ("Jenis Transaksi", "Pembayaran BRIVA"),
            ("?Nominal", "Rp{dot}"),
            ("Biaya Admin", "Rp{fee_dot}"),
        ),
    ),
    (
        "bri", "bpjs", _BRI, "Pembayaran",
        _rows(
            ("Tanggal", "{d} {bulan} {y} | {hms} WIB"),
            ("Nomor Referensi", "{id}"),
            ("Institusi", "BPJS Kesehatan"),
            ("Nomor", "8888801234567"),
            ("?Nominal", "Rp{dot}"),
            ("Biaya Admin", "Rp{fee_dot}"),
        ),
    ),
    (
        "bri", "qris", _BRI, "Pembelian",
        _rows(
            ("Tanggal", "{d} {mon} {y} | {hms} WIB"),
            ("Nomor Referensi", "{id}"),
            ("Jenis Transaksi", "Pembelian QRIS"),
            ("Nama Merchant", "{merchant}"),
            ("Lokasi Merchant", "Kota ID"),
            ("Nama Penerbit", "BRI"),
            ("Nama Acquirer", "Bank Lain"),
            ("Biaya Admin", "Rp{fee_comma}"),
            ("?Total", "Rp{dot}"),
        ),
    ),
    (
        "bri", "electricity", _BRI, "Pembayaran",
        "<p>PembayaranTAGIHAN LISTRIK</p>"
        "<table><tr><td>Tanggal Pembayaran</td><td>{d} {bulan} {y} , {hm} WIB</td></tr>"
        "<tr><td>Nomor Referensi</td><td>{id}</td></tr>"
        "<tr><td>TARIF/DAYA</td><td>R1/900 VA.</td></tr></table>"
        + _rows(("?RP TAG PLN", "Rp{dot},00"), ("ADMIN BANK", "Rp{fee_dot},00")),
    ),
    (
        "bri", "credit", _BRI, "Pembelian",
        _rows(
            ("Tanggal", "{d} {bulan} {y} | {hms} WIB"),
            ("Nomor Referensi", "{id444}"),
            ("Jenis Transaksi", "Pulsa"),
            ("Provider", "{merchant}"),
            ("Jenis Produk", "Pulsa 50"),
            ("*", "*"),
            ("?Nominal", "Rp{dot}"),
            ("Biaya Admin", "Rp{fee_dot}"),
        ),
    ),
    (
        "bri", "transfer", _BRI, "Pemindahan",
        _rows(
            ("Tanggal", "{d} {bulan} {y} , {hms} WIB"),
            ("Nomor Referensi", "{id}"),
            ("Jenis Transaksi", "Transfer BI-FAST"),
            ("Bank Tujuan", "{merchant}"),
            ("Nomor Tujuan", "6120 4876 88"),
            ("?Nominal", "Rp{dot}"),
            ("Biaya Admin", "Rp{fee_dot}"),
        ),
    ),
    (
        "epic", "receipt", "help@accts.epicgames.com", "Your Epic Games Receipt A{id}",
        "<p>INVOICE ID: A{id}</p><p>Source: Game Store {month} {d1}, {y} {merchant}</p>"
        "<<<p>Price: Star Quest {merchant} Rp{comma2} IDR</p>>><p>PAID FROM: GOPAY[IDR]</p>",
    ),
    (
        "gofood", "receipt", "no-reply@invoicing.gojek.com", "Your food order with Gojek",
        "{gofood_date}<p>Order ID: F-{number}</p><p>from</p><p>{merchant}, Kota</p>"
        + _rows(("?Total payment", "Rp{dot}"), ("Paid with {gofood_pay}",)),
    ),
    (
        "google_play", "receipt", "googleplay-noreply@google.com",
        "Your Google Play Order Receipt",
        "<p>You bought an item from {merchant} on Google Play.</p>"
        "<p>Order number: GPA.{gpa}<br>Order date: {d1} {play_mon} {y} {hms} GMT+7</p>"
        "<<<p>Total: Rp {dot},00</p>>><p>Payment method: ShopeePay: **** 6235</p>",
    ),
    (
        "grab", "car", "no-reply@grab.com", "Your Grab E-Receipt",
        "<table><tr><td>GrabCar</td></tr></table>"
        "<table><tr><td>Picked up on {d1} {month} {y} <b>Booking ID:</b> A-{id}</td></tr></table>"
        + "<table><tr><td>x</td></tr></table>" * 6
        + "<table><tr><td>Total</td><td><<{dot},00>></td></tr></table>"
        "<table><tr><td>x</td></tr></table>"
        "<table><tr><td>Paid by</td><td>OVO</td></tr></table>",
    ),
    (
        "grabfood", "receipt", "no-reply@grab.com", "Your Grab E-Receipt",
        "<h2>Selamat menikmati makanan Anda!</h2><p>{d} {mon} {yy} {hm} +0700</p>"
        "<p>Pesanan Dari:</p><p>{merchant}</p><p>Pesanan ID</p><p>IN-{id}</p>"
        "<<<p>TOTAL (INCL. TAX) Rp {plain}</p>>><p>Cash</p>",
    ),
    (
        "gotagihan", "receipt", "receipts@gotagihan.gojek.com", "Tagihan lunas",
        "<table><tr><td>Tanggal</td><td>{d} {mon} {y}, {hm}</td></tr></table>"
        "<table><tr><td>1</td><td>{merchant}</td><td>Rp<<{dot}>></td></tr></table>"
        "<p>Payment ID - {id}-GOBILLS</p>",
    ),
    (
        "itemku", "receipt", "no-reply@itemku.com", "Pembayaran pesanan {number} telah kami terima",
        "<p>No. Transaksi: TR{id}</p><p>Tanggal transaksi: {d1} {itemku_mon} {y} pukul {hms}</p>"
        "<p>Akun game {number}</p><p>Biaya Layanan QRIS</p><<<p>Total Pembayaran Rp. {dot}</p>>>",
    ),
    (
        "jago", "receipt", "noreply@jago.com", "Kamu telah membayar {merchant}",
        _rows(
            ("Dari", "MA 1039"),
            ("Ke", "{merchant}"),
            ("?Jumlah", "Rp{dot}"),
            ("Tanggal transaksi", "{d1} {month} {y} {hm} WIB"),
        ),
    ),
    (
        "livin", "transfer", _LIVIN, "Transfer Berhasil",
        "<h2>Transfer Berhasil</h2><p>Penerima</p><h4>{merchant}</h4>"
        "<table><tr><td>Tanggal</td><td>{d1} {bul} {y}</td></tr>"
        "<tr><td>Jam</td><td>{hms} WIB</td></tr>"
        "<<<tr><td>Jumlah Transfer</td><td>Rp{dot},75</td></tr>>>"
        "<tr><td>No. Referensi</td><td>{id}</td></tr>"
        "<tr><td>Keterangan</td><td>-</td></tr></table>",
    ),
    (
        "livin", "topup", _LIVIN, "Top-up Berhasil",
        "<h2>Top-up Berhasil</h2><p>Penyedia Jasa</p><h4>{merchant}</h4>"
        + _rows(
            ("Tanggal", "{d1} {bul} {y}"),
            ("Jam", "{hms} WIB"),
            ("?Total Transaksi", "Rp {dot},00"),
            ("No. Referensi", "{id}"),
        ),
    ),
    (
        "livin", "payment", _LIVIN, "Pembayaran Berhasil",
        "<h2>Pembayaran Berhasil</h2><p>Penerima</p><h4>{merchant}</h4>"
        + _rows(
            ("Tanggal", "{d1} {bul} {y}"),
            ("Jam", "{hms} WIB"),
            ("?Nominal Transaksi", "Rp {dot},00"),
            ("No. Referensi", "{id}"),
        ),
    ),
    (
        "mobapay", "receipt", "mobapay@mail.mobapay.com", "Payment Successful",
        "<p>Order No.: MP{id}</p><p>Payment Time: {iso} {hms} (UTC)</p>"
        "<p>Item Name: Gems {number}</p><p>Currency: IDR</p><<<p>Price: {comma}</p>>>"
        "<p>Payment Methods: QRIS</p><p>Subtotal: -</p>",
    ),
    (
        "ocbc", "transfer", "notifikasi@ocbc.id", "Notifikasi Transfer Dana Masuk",
        "<h3>TRANSFER DANA</h3><p>telah menerima Transfer BI-Fast dengan rincian:</p>"
        + _rows(
            ("Bank Pengirim", ": BANK SATU"),
            ("Nama Pengirim", ": {segment}"),
            ("?Nominal", ": Rp {dot},00"),
            ("Bank Penerima", ": {merchant}"),
            ("Nama Penerima", ": Budi"),
            ("Tanggal Transaksi", ": {d} {bulan} {y}"),
            ("Waktu Transaksi", ": {hms}"),
        ),
    ),
    (
        "ocbc", "qr_en", _OCBC, "Successful QR Payment {id}",
        "<p>Reference No.: MB{id}</p><p>Payment Date: {dmy}</p>"
        + _rows(
            ("QR Payment",),
            ("Merchant PAN", _PAN, "{merchant}"),
            ("Tip", "IDR {fee_comma2}"),
            ("?Amount Pay", "IDR {comma2}"),
        ),
    ),
    (
        "ocbc", "qr_id", _OCBC, "Pembayaran QR Berhasil {id}",
        "<p>No. Referensi: MB{id}</p><p>TANGGAL PEMBAYARAN: {dmy}</p>"
        + _rows(
            ("Pembayaran QR",),
            ("PAN Merchant", _PAN, "{merchant}"),
            ("Tip", "IDR {fee_comma2}"),
            ("?Nominal Bayar", "IDR {comma2}"),
        ),
    ),
    (
        "ocbc", "funds", _OCBC, "Successful Funds Transfer {id}",
        "<p>Successful Funds Transfer</p><p>Reference Number: MB{id}</p>"
        "<p>TRANSFER DATE: {d} {mon} {y} {hms} WIB</p><p>FROM</p><p>Budi Santoso TANDA IDR</p>"
        "<p>TO</p><p>Penerima Uang {merchant} 6938</p><<<h4>IDR {comma}</h4>>>"
        "<p>Fees IDR 0</p>",
    ),
    (
        "ocbc", "topup", _OCBC, "Successful Payment {id}",
        "<p>Successful Bill Payment</p><p>Reference Number: MB{id}</p>"
        "<p>PAYMENT DATE: {d} {mon} {y} {hms} WIB</p><<<p>AMOUNT IDR {comma}</p>>>"
        "<p>TO</p><p>{merchant}</p><p>082110005254</p>",
    ),
    (
        "ovo", "receipt", "noreply@ovo.co.id", "OVO QR Payment Receipt",
        "<p>{d} {mon} {yy}, {hm}</p>"
        + _rows(
            ("Nama Toko", "{merchant}"),
            ("Lokasi", "Kota"),
            ("No. Resi (Kode Transaksi)", "r{id}"),
            ("Metode", "OVO Cash"),
            ("Tip", "Rp{fee_plain}"),
            ("?Pembayaran", "Rp{dot}"),
        ),
    ),
    (
        "paypal", "sent", _PAYPAL, "You sent a payment",
        "<p>You sent a payment to {merchant}</p><<<p>You paid ${usd} USD</p>>>"
        + _lines(
            ("Transaction date", "{d1} {month} {y}"),
            ("Merchant", "{merchant}"),
            ("Transaction ID", "PP{id}"),
            ("YOUR NOTES FOR {segment}", "Order {number}"),
        )
        + "<p>End</p>",
    ),
    (
        "paypal", "payment", _PAYPAL, "Receipt for your payment to {merchant}",
        "<p>Rincian pembayaran anda</p><<<p>Total ${usd} USD</p>>>"
        + _lines(
            ("Tanggal transaksi", "{d1} {bulan} {y}"),
            ("Merchant", "{merchant}"),
            ("ID transaksi", "PP{id}"),
        )
        + "<p>Selesai</p>",
    ),
    (
        "paypal", "received", _PAYPAL, "You've received a payment",
        "<p>{segment} has sent you money</p><<<p>Amount received ${usd} USD</p>>>"
        + _lines(
            ("Transaction date", "{d1} {mon} {y}"),
            ("Merchant", "{merchant}"),
            ("Transaction ID", "PP{id}"),
        )
        + "<p>End</p>",
    ),
    (
        "seabank", "instant", "alerts@seabank.co.id", "Notifikasi Transaksi SeaBank",
        _lines(
            ("Waktu Transaksi", "{d} {mon} {y} {hm}"),
            ("Jenis Transaksi", "SeaBank Bayar Instan"),
            ("Nama Merchant", "{merchant}"),
            ("?Jumlah", "Rp{dot}"),
            ("No. Referensi", "{id}"),
            ("Catatan", "Note of {segment}"),
        ),
    ),
    (
        "seabank", "transfer", "alerts@seabank.co.id", "Notifikasi Transfer SeaBank",
        _lines(
            ("Waktu Transaksi", "{d} {mon} {y} {hm}"),
            ("Jenis Transaksi", "Real Time (BI-FAST)"),
            ("Rekening Tujuan", "JAGO {merchant} {number}"),
            ("?Jumlah", "Rp{dot}"),
            ("No. Referensi", "{id}"),
            ("Catatan", "Rent and food"),
        ),
    ),
    (
        "steam", "receipt", "noreply@steampowered.com", "Thank you for your Steam purchase!",
        "<p>Invoice: {id}</p><p>Date issued: {d1} {mon}, {y} @ {clock} WIB</p>"
        "<<<p>Your total for this transaction: Rp {space}</p>>><p>Payment method: Visa</p>",
    ),
    (
        "tokopedia", "receipt", "noreply@tokopedia.com", "Checkout Pesanan dengan GoPay",
        "<table><tr><td>a</td></tr></table>" * 3
        + "<table><tr><td>Total</td><td>Rp<< {dot}>></td></tr>"
        "<tr><td>Metode</td><td>GoPay</td></tr>"
        "<tr><td>Waktu</td><td>{hari}, {d} {bulan} {y}, {hm} WIB</td></tr></table>"
        "<p>Toko: {merchant}</p><p>No. Invoice: INV/{number}/MPL</p><p>-</p>",
    ),
    (
        "unipin", "receipt", "do_not_reply@unipin.com", "UniPin :: Success Flash Top Up Transaction",
        "<p>UniPin</p>"
        + _rows(
            ("Waktu Pembayaran", "{d1} {mon} {y} {hm} (GMT +7)"),
            ("Metode Pembayaran", "QRIS"),
            ("Nomor Transaksi", "U{id}"),
            ("Nama Barang", "Gems {number}"),
            ("Nominal Transaksi", "Rp<<{comma}>>"),
        ),
    ),
    (
        "xsolla", "receipt", "mailer@xsolla.com", "Your receipt No. {id}",
        "<p>Product - Coins {number}</p><p>Company {merchant} Inc.</p><p>Transaction number {id}</p>"
        "<p>Transaction date {mdy}</p><<<p>Total Rp{space}.00</p>>>"
        "<p>Including 11% VAT : Rp{fee_space}.00</p>",
    ),
]


#: Marks that stand for one of two templates, by what the key is divisible by.
_EITHER = {
    "gofood_pay": (3, "GoPay</td> <td>Rp1.000</td></tr><tr><td>Paid with Cash</td> <td>Rp2.000", "GoPay</td> <td>Rp1.000"),
    "gofood_date": (2, "<p>{weekday}, {d1} {month} {y}</p>", "<p>Diantarkan {d1} {bulan} {y} at {hm}</p>"),
}


def _fill(template: str, values: dict[str, Column], k: Column) -> Column:
    """A template with its marks ``{name}`` replaced; what stands in ``<<`` and ``>>`` is left out where the amount is."""
    parts = []
    for piece in re.split(r"(<<.*?>>(?!>)|\{\w+\})", template, flags=re.S):
        if piece.startswith("<<") and piece.endswith(">>"):
            parts.append(F.when(k % 17 != 0, _fill(piece[2:-2], values, k)).otherwise(""))
        elif piece.startswith("{") and piece[1:-1] in _EITHER:
            by, one, other = _EITHER[piece[1:-1]]
            parts.append(F.when(k % by == 0, _fill(one, values, k)).otherwise(_fill(other, values, k)))
        elif re.fullmatch(r"\{\w+\}", piece):
            parts.append(values[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


@lru_cache(maxsize=8)
def _texts(session: SparkSession) -> tuple[Column, Column, Column]:
    """Sender, subject and body of an order by its layout, of which only the values that it prints are made.

    Columns belong to a session. The CASE over all layouts sits inside a lambda, as that of the rules in ``extract``.
    """
    whole = F.col("k").isNotNull() & F.col("amount").isNotNull() & F.col("ts").isNotNull() & F.col("segment").isNotNull()

    def by_layout(text: Callable[[int, Column, dict[str, Column]], Column]) -> Callable[[Column], Column]:
        def case(m: Column) -> Column:
            values = _values(m)
            return switch(m["layout"], {i: text(i, m["k"], values) for i in range(len(LAYOUTS))})

        return case

    layout = (F.col("k") % len(LAYOUTS)).cast("int")
    row = F.struct("k", "amount", "ts", "segment", "merchant", layout.alias("layout"))
    addr = F.element_at(F.split(F.lit("\u0002".join(t[2] for t in LAYOUTS)), "\u0002"), layout + 1)
    subject = bind(row, by_layout(lambda i, k, values: _fill(LAYOUTS[i][3], values, k)))
    body = bind(row, by_layout(lambda i, k, values: _fill(LAYOUTS[i][4], values, k)))
    return addr, F.when(whole, subject), F.when(whole, body)


def render_emails(spark: SparkSession, sf: str) -> DataFrame:
    """The EMAILS table rendered from every order, with the faults of the module's head.

    Each column is an expression of its own: what a reader does not use is not made.
    """
    k = F.col("k")
    addr, subject, body = _texts(spark)
    html = F.concat(
        F.lit("<html><head><style>td{padding:1px}</style></head><body>"), body, F.lit("</body></html>")
    )
    space = F.when(k % 26 == 0, F.lit("&nbsp;")).when(k % 26 == 13, F.lit("\u00a0"))
    html = bind(html, lambda h: F.when(space.isNotNull(), F.replace(h, F.lit(" "), space)).otherwise(h))
    header = F.when(k % 2 == 0, F.concat(F.lit('"Notifier" <'), addr, F.lit(">"))).otherwise(addr)
    copies = F.when(k % 19 == 0, F.array(F.lit(""), F.lit("-2"))).otherwise(F.array(F.lit("")))
    # behind a generator, so that readers' filters on a title are not moved before the rows are dealt
    sent = F.transform(copies, lambda copy: F.struct("k", "amount", "ts", "segment", "merchant", copy.alias("_copy")))
    return (
        orders_base(spark, sf)
        .select(F.inline(sent))
        .select("*", F.concat(k.cast("string"), F.col("_copy")).alias("message_id"), header.alias("from_header"))
        .select(
            "message_id",
            F.when(k % 23 == 0, F.lit("Weekly newsletter")).otherwise(subject).alias("subject"),
            "from_header",
            parse_addr(F.col("from_header")).alias("from_addr"),
            extract_domain(F.col("from_header")).alias("from_domain"),
            html.alias("body_html"),
            F.lit(None).cast("string").alias("body_text"),
        )
    )
