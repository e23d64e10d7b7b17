"""Schemas of the payload document and of the ledger."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the payload document (fixed values of the message format).
MASTER_FIELDS = (
    "ngayCT", "maCT", "soCT", "maBoPhan", "maDonHang", "tenKhachHang", "soDienThoai",
    "tinhThanh", "quanHuyen", "phuongXa", "diaChi", "sourceType",
)
DETAIL_FIELDS = ("maHang", "tenHang", "imei", "soLuong", "doanhThu")


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Numbers are read as text and cast later: JSON "5" under a double field would turn into NULL.
PAYLOAD = T.StructType([
    T.StructField("apikey", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("master", _strings(MASTER_FIELDS)),
        T.StructField("detail", T.ArrayType(_strings(DETAIL_FIELDS))),
    ]))),
])

LINE_KEY = ("order_id", "product_code", "imei")

LEDGER = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("document_number", T.StringType()),
    T.StructField("department_code", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("ward", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("imei", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("revenue", T.DecimalType(15, 2)),
    T.StructField("source_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("first_failure_time", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
LEDGER_COLUMNS = tuple(LEDGER.names)

# Which payload field fills which ledger column (fixed values of the message format).
MASTER_TO_LEDGER = {
    "tenKhachHang": "customer_name",
    "soDienThoai": "phone_number",
    "maCT": "document_type",
    "soCT": "document_number",
    "maBoPhan": "department_code",
    "ngayCT": "order_date",
    "tinhThanh": "province",
    "quanHuyen": "district",
    "phuongXa": "ward",
    "diaChi": "address",
}
DETAIL_TO_LEDGER = {
    "maHang": "product_code",
    "tenHang": "product_name",
    "imei": "imei",
    "soLuong": "quantity",
    "doanhThu": "revenue",
}
