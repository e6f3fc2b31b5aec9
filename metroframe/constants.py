"""Fixed values that must equal the reference platform's for equal results.

Everything here is data, kept as plain text in its natural order.
"""

# --- fixed values: bus stop id prefix (first three digits) -> district -----
# (district, ARS prefix as in the lookup file, 3-digit stop-id prefix)
BUS_STOP_CODE_LOOKUP = [
    ("종로구", 1, "100"),
    ("중구", 2, "101"),
    ("용산구", 3, "102"),
    ("성동구", 4, "103"),
    ("광진구", 5, "104"),
    ("동대문구", 6, "105"),
    ("중랑구", 7, "106"),
    ("성북구", 8, "107"),
    ("강북구", 9, "108"),
    ("도봉구", 10, "109"),
    ("노원구", 11, "110"),
    ("은평구", 12, "111"),
    ("서대문구", 13, "112"),
    ("마포구", 14, "113"),
    ("양천구", 15, "114"),
    ("강서구", 16, "115"),
    ("구로구", 17, "116"),
    ("금천구", 18, "117"),
    ("영등포구", 19, "118"),
    ("동작구", 20, "119"),
    ("관악구", 21, "120"),
    ("서초구", 22, "121"),
    ("강남구", 23, "122"),
    ("송파구", 24, "123"),
    ("강동구", 25, "124"),
]

# --- fixed values: district -> code in requests for popular loans -----------
LOAN_REGION = 11
LOAN_PAGE_SIZE = 200
LOAN_DISTRICT_CODES = [
    ("강남구", 11230),
    ("강동구", 11250),
    ("강북구", 11090),
    ("강서구", 11160),
    ("관악구", 11210),
    ("광진구", 11050),
    ("구로구", 11170),
    ("금천구", 11180),
    ("노원구", 11110),
    ("도봉구", 11100),
    ("동대문구", 11060),
    ("동작구", 11200),
    ("마포구", 11140),
    ("서대문구", 11130),
    ("서초구", 11220),
    ("성동구", 11040),
    ("성북구", 11080),
    ("송파구", 11240),
    ("양천구", 11150),
    ("영등포구", 11190),
    ("용산구", 11030),
    ("은평구", 11120),
    ("종로구", 11010),
    ("중구", 11020),
    ("중랑구", 11070),
]

# --- fixed values: words dropped before keyword counting (20 words) --------
KEYWORD_STOP_WORDS = [
    "금", "중", "일", "월", "서울", "문화", "정보", "신청", "행사", "관광",
    "축제", "문의", "홈페이지", "위치", "전체", "전화", "서울시", "년", "및", "기타",
]

# --- fixed values: API status codes ----------------------------------------
STATUS_OK = "INFO-000"
STATUS_NO_DATA = "INFO-200"

# --- fixed values: free / paid labels of the event feed --------------------
FEE_FREE = "무료"
FEE_PAID = "유료"

# --- fixed values: regex patterns ------------------------------------------
HANGUL_WORD = "[가-힣]+"
PARENTHESISED = r"\(.*?\)"
SEOUL_DISTRICT = r"서울특별시\s([가-힣]+구)"
CATEGORY_SEPARATOR = " > "
STATION_LIST_SEPARATOR = ", "

# --- fixed values: keyword extraction --------------------------------------
TOP_KEYWORDS = 3

# --- fixed values: accessibility mart ----------------------------------------
RADIUS_M = 1000.0
DATA_TYPES = ["Library", "Event", "Book"]
FACILITY_TYPES = ["Bus", "Subway", "Park"]
