"""Small dimension tables behind the fixture generator.

The texts are invented; a text with a placeholder counts as one with personal data.
All are fixed in size, so joining them never shuffles the generated rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeveil.functions.sqltext import pick
from lakeveil.plans.seeds import codes_frame, literal_frame

# The 34 provinces (public administrative codes and names).
PROVINCES = {
    "01": "Thành phố Hà Nội",
    "04": "Tỉnh Cao Bằng",
    "08": "Tỉnh Tuyên Quang",
    "11": "Tỉnh Điện Biên",
    "12": "Tỉnh Lai Châu",
    "14": "Tỉnh Sơn La",
    "15": "Tỉnh Lào Cai",
    "19": "Tỉnh Thái Nguyên",
    "20": "Tỉnh Lạng Sơn",
    "22": "Tỉnh Quảng Ninh",
    "24": "Tỉnh Bắc Ninh",
    "25": "Tỉnh Phú Thọ",
    "31": "Thành phố Hải Phòng",
    "33": "Tỉnh Hưng Yên",
    "37": "Tỉnh Ninh Bình",
    "38": "Tỉnh Thanh Hoá",
    "40": "Tỉnh Nghệ An",
    "42": "Tỉnh Hà Tĩnh",
    "44": "Tỉnh Quảng Trị",
    "46": "Thành phố Huế",
    "48": "Thành phố Đà Nẵng",
    "51": "Tỉnh Quảng Ngãi",
    "52": "Tỉnh Gia Lai",
    "56": "Tỉnh Khánh Hoà",
    "66": "Tỉnh Đắk Lắk",
    "68": "Tỉnh Lâm Đồng",
    "75": "Thành phố Đồng Nai",
    "79": "Thành phố Hồ Chí Minh",
    "80": "Tỉnh Tây Ninh",
    "82": "Tỉnh Đồng Tháp",
    "86": "Tỉnh Vĩnh Long",
    "91": "Tỉnh An Giang",
    "92": "Thành phố Cần Thơ",
    "96": "Tỉnh Cà Mau",
}

# How many wards there are. Their names follow a rule below.
WARD_COUNT = 3321
WARD_KINDS = ["Phường", "Xã"]
WARD_FIRST = ["An", "Bình", "Cẩm", "Đông", "Hòa", "Long", "Minh", "Phú", "Tân", "Thanh", "Vĩnh", "Xuân"]
WARD_SECOND = ["Hà", "Khê", "Lộc", "Mỹ", "Ninh", "Phong", "Quang", "Sơn", "Thủy", "Trung", "Yên"]

REGIONS = ["Northern uplands", "Northern plain", "Central coast", "Central uplands", "Southern plain", "Islands"]
# A region is one or several runs of province codes; a run goes from its first code to the next run's.
REGION_RUNS = {
    "01": "Northern plain",
    "04": "Northern uplands",
    "24": "Northern plain",
    "38": "Central coast",
    "52": "Central uplands",
    "56": "Central coast",
    "66": "Central uplands",
    "75": "Southern plain",
}
# Kinds of provinces and wards, by the first words of their names.
UNIT_PREFIXES = {"City": "Thành phố", "Province": "Tỉnh", "Ward": "Phường", "Commune": "Xã"}
UNITS = list(UNIT_PREFIXES)

SERVICE_TYPES = ["Đăng ký xe", "Cấp hộ chiếu", "Trợ cấp xã hội", "Đăng ký tạm trú"]
RECORD_STATUSES = ["RECEIVED", "IN_REVIEW", "WAITING_FOR_CITIZEN", "GRANTED", "REFUSED", "WITHDRAWN"]

# One note per (service, status), in that order; a placeholder marks personal data.
CLERK_NOTES = [
    "Xe chuyển từ tỉnh khác đến, chủ xe ${full_name}.",
    "Đối chiếu số khung và số máy.",
    "Chờ chủ xe mang xe tới cà số.",
    "Biển số mới, lệ phí hoàn vào ${bank_account}.",
    "Xe thuộc diện phạt nguội chưa nộp.",
    "Chủ xe đổi ý, rút lại giấy tờ.",
    "Hẹn chụp ảnh ngày thứ ba.",
    "Hộ chiếu cũ mang số ${national_id}, chờ hủy.",
    "Nhắn ${phone_number} bổ sung ảnh nền trắng.",
    "Giao tại nhà, ký nhận đủ.",
    "Tên trên đơn sai dấu so với khai sinh.",
    "Người nộp xin dời sang năm sau.",
    "Trưởng thôn nộp thay cho ${full_name}.",
    "Tổ công tác tới thăm hộ gia đình.",
    "Chưa có xác nhận thu nhập của xã.",
    "Chi trả hằng tháng qua tài khoản ${bank_account}, báo ${email}.",
    "Hộ đã thoát nghèo từ quý trước.",
    "Chuyển hưởng chế độ khác.",
    "Chủ trọ khai báo ba người ở.",
    "Công an khu vực kiểm tra buổi tối.",
    "Hợp đồng thuê nhà hết hạn, hỏi lại qua ${email}.",
    "Thời hạn hai năm, mã định danh ${national_id}.",
    "Nhà thuê chưa đủ diện tích tối thiểu.",
    "Đã chuyển đi nơi khác, số cũ ${phone_number}.",
]

TX_TYPES = ["CARD", "WIRE", "CASH_IN", "CASH_OUT", "BILL", "REFUND", "FEE"]
TX_MESSAGES = [
    "ve xem phim cuoi tuan",
    "hoan tien don hang, nhan tai ${bank_account}",
    "hoc phi lop ve",
    "thue xe ${phone_number} ba ngay",
    "mung cuoi",
    "nop thue thang, ma ${tax_id}",
    "sua mai nha",
    "dang ky su kien, ve gui ${email}",
    "tien gui xe quy nay",
]
FRAUD_NOTES = [
    "Ba máy rút tiền khác nhau trong mười phút, thẻ của ${national_id}.",
    "Chuỗi lệnh nhỏ lẻ tới ${bank_account} ngay sau nửa đêm.",
    "Cảnh báo do đổi múi giờ, đóng lại.",
    "Cửa hàng mang mã thuế ${tax_id} đã ngừng hoạt động.",
    "Người gọi tự xưng nhân viên, để lại số ${phone_number}.",
    "Mẫu chữ ký lệch nhẹ, chấp nhận.",
    "Thư giả mạo gửi từ ${email}, chưa mất tiền.",
    "Giao dịch trùng do lỗi mạng.",
]

DEPARTMENTS = ["Kho vận", "Thiết kế", "Mua hàng", "An ninh", "Bảo trì", "Chất lượng", "Đào tạo"]
HR_REMARKS = [
    "Làm ca đêm đến hết mùa.",
    "Báo tin cho ${emergency_name} khi cần.",
    "Được cấp xe máy của công ty.",
    "",
    "Sổ thuế ghi sai, đúng là ${tax_id}.",
    "Tập huấn phòng cháy tháng tới.",
    "Hoàn công tác phí về ${bank_account}, biên nhận gửi ${email}.",
    "Thẻ ra vào gắn với ${national_id}.",
    "Số liên lạc mới ${phone_number}.",
    "Nhường suất đào tạo cho tổ khác.",
    "Dị ứng phấn hoa, tránh việc ngoài vườn.",
]

FAMILY_NAMES = ["Nguyễn", "Trần", "Lê", "Phạm", "Hoàng", "Phan", "Vũ", "Đặng", "Bùi", "Đỗ", "Hồ", "Ngô"]
MIDDLE_NAMES = ["Văn", "Thị", "Hữu", "Đức", "Minh", "Ngọc", "Thanh", "Quốc"]
GIVEN_NAMES = ["An", "Bình", "Chi", "Dũng", "Giang", "Hà", "Hùng", "Khánh", "Lan", "Linh", "Mai", "Nam", "Phúc", "Quân"]
MAIL_NAMES = ["an", "binh", "chi", "dung", "giang", "ha", "hung", "khanh", "lan", "linh", "mai", "nam", "phuc", "quan"]
MAIL_DOMAINS = ["example.com", "example.net", "example.org"]
STREETS = ["Lê Lợi", "Trần Phú", "Hai Bà Trưng", "Nguyễn Huệ", "Lý Thường Kiệt", "Quang Trung", "Hùng Vương"]
JOBS = ["Giáo viên", "Kỹ sư", "Bác sĩ", "Kế toán viên", "Công nhân", "Nông dân", "Tài xế", "Thợ điện"]


def regions(spark: SparkSession) -> DataFrame:
    """(region_id, region)"""
    return codes_frame(spark, REGIONS, "region").withColumnRenamed("id", "region_id")


def units(spark: SparkSession) -> DataFrame:
    """(unit_id, unit)"""
    return codes_frame(spark, UNITS, "unit").withColumnRenamed("id", "unit_id")


def unit_id(name: str) -> int:
    """The id of the kind of province or ward that bears this name."""
    return 1 + next(i for i, prefix in enumerate(UNIT_PREFIXES.values()) if name.startswith(f"{prefix} "))


def region_id(code: str) -> int:
    """The id of the region that holds the province of this code."""
    return 1 + REGIONS.index(REGION_RUNS[max(first for first in REGION_RUNS if first <= code)])


def provinces(spark: SparkSession) -> DataFrame:
    """(code, full_name, region_id, unit_id)"""
    schema = pa.schema(
        [("code", pa.string()), ("full_name", pa.string()), ("region_id", pa.int32()), ("unit_id", pa.int32())]
    )
    columns = {
        "code": list(PROVINCES),
        "full_name": list(PROVINCES.values()),
        "region_id": [region_id(code) for code in PROVINCES],
        "unit_id": [unit_id(name) for name in PROVINCES.values()],
    }
    return literal_frame(spark, columns, schema)


def wards(spark: SparkSession) -> DataFrame:
    """(code, ward_index, full_name, province_code, unit_id): names, provinces and units follow from the index."""
    first = pick(WARD_FIRST, f"id div 2 % {len(WARD_FIRST)}")
    second = pick(WARD_SECOND, f"id div {2 * len(WARD_FIRST)} % {len(WARD_SECOND)}")
    number = f"id div {2 * len(WARD_FIRST) * len(WARD_SECOND)} + 1"
    return spark.range(WARD_COUNT).selectExpr(
        "lpad(cast(id + 1 as string), 5, '0') as code",
        "id as ward_index",
        f"concat({pick(WARD_KINDS, 'id % 2')}, ' ', {first}, ' ', {second}, ' ', {number}) as full_name",
        f"{pick(list(PROVINCES), f'id % {len(PROVINCES)}')} as province_code",
        f"cast({pick([str(unit_id(f'{kind} ')) for kind in WARD_KINDS], 'id % 2')} as int) as unit_id",
    )


def ward_chain(spark: SparkSession) -> DataFrame:
    """(ward_index, ward_name, ward_unit, province_code, province_name, province_unit, region): every ward with all above it."""
    u = units(spark)
    ward_units = u.select(F.col("unit_id"), F.col("unit").alias("ward_unit"))
    above = provinces(spark).select(F.col("code").alias("province_code"), F.col("full_name").alias("province_name"), "region_id", "unit_id")
    above = above.join(F.broadcast(u.withColumnRenamed("unit", "province_unit")), "unit_id").drop("unit_id")
    above = above.join(F.broadcast(regions(spark)), "region_id").drop("region_id")
    below = wards(spark).withColumnRenamed("full_name", "ward_name").join(F.broadcast(ward_units), "unit_id")
    return below.join(F.broadcast(above), "province_code").select(
        "ward_index", "ward_name", "ward_unit", "province_code", "province_name", "province_unit", "region"
    )


def address_pool(spark: SparkSession) -> DataFrame:
    """(ward_index, ward_name, province_name): wards with their provinces."""
    w, p = wards(spark), provinces(spark)
    return w.join(F.broadcast(p), w.province_code == p.code).select(
        "ward_index", w.full_name.alias("ward_name"), p.full_name.alias("province_name")
    )


def texts_frame(spark: SparkSession, texts: list[str]) -> DataFrame:
    """(template_index, contain_pii, template_text)"""
    schema = pa.schema(
        [("template_index", pa.int64()), ("contain_pii", pa.bool_()), ("template_text", pa.string())]
    )
    columns = {
        "template_index": list(range(len(texts))),
        "contain_pii": ["${" in t for t in texts],
        "template_text": texts,
    }
    return literal_frame(spark, columns, schema)


def clerk_note_templates(spark: SparkSession, texts: list[str] = CLERK_NOTES) -> DataFrame:
    """(template_index, service_type_id, status_id, contain_pii, template_text)"""
    n = len(RECORD_STATUSES)
    return texts_frame(spark, texts).select(
        "template_index",
        F.expr(f"cast(template_index div {n} + 1 as int)").alias("service_type_id"),
        F.expr(f"cast(template_index % {n} + 1 as int)").alias("status_id"),
        "contain_pii",
        "template_text",
    )


def note_pool(spark: SparkSession, texts: list[str] = CLERK_NOTES) -> DataFrame:
    """(template_index, service_type, status, contain_pii, template_text)"""
    services = codes_frame(spark, SERVICE_TYPES, "service_type").withColumnRenamed("id", "service_type_id")
    statuses = codes_frame(spark, RECORD_STATUSES, "status").withColumnRenamed("id", "status_id")
    return (
        clerk_note_templates(spark, texts)
        .join(F.broadcast(services), "service_type_id")
        .join(F.broadcast(statuses), "status_id")
        .select("template_index", "service_type", "status", "contain_pii", "template_text")
    )


def dimension_entries(spark: SparkSession) -> DataFrame:
    """(dimension, entries): the size of every dimension."""
    sizes = {
        "administrative_regions": len(REGIONS),
        "administrative_units": len(UNITS),
        "provinces": len(PROVINCES),
        "wards": WARD_COUNT,
        "service_types": len(SERVICE_TYPES),
        "record_statuses": len(RECORD_STATUSES),
        "clerk_notes_templates": len(CLERK_NOTES),
        "tx_types": len(TX_TYPES),
        "tx_message_templates": len(TX_MESSAGES),
        "fraud_note_templates": len(FRAUD_NOTES),
        "departments": len(DEPARTMENTS),
        "hr_remarks_templates": len(HR_REMARKS),
    }
    schema = pa.schema([("dimension", pa.string()), ("entries", pa.int64())])
    return literal_frame(spark, {"dimension": list(sizes), "entries": list(sizes.values())}, schema)
