"""Fixed values.

Field names, phrases, labels, limits and word lists that the results depend on. They are plain
data; the modules that use them hold the logic.
"""

# Search-API field -> output column (19 fields).
SEARCH_FIELDS = {
    "listing_id": "listing_id",
    "title": "product",
    "price": "price",
    "listing_age_in_months": "listing_age",
    "views": "total_views",
    "num_favorers": "total_favorites",
    "est_reviews": "total_reviews",
    "est_reviews_in_months": "avg_reviews",
    "shop_age_month": "shop_age",
    "transaction_sold_count": "total_shop_sales",
    "main_category": "category",
    "listing_type": "listing_type",
    "url": "etsy_url",
    "shipping_from_country_iso": "ship_from",
    "cached_visibility_score": "visibility_score",
    "est_mo_sales": "mo_sales",
    "est_mo_revenue": "mo_revenue",
    "est_total_sales": "total_sales_est",
    "growth_rate": "growth_rate",
}

# Output column order of search listings.
SEARCH_ORDER = [
    "listing_id", "product", "shop_name", "price", "listing_age", "created_age", "total_views",
    "views_per_month", "total_reviews", "avg_reviews", "total_favorites", "shop_age",
    "total_shop_sales", "category", "listing_type", "ship_from", "etsy_url", "tags",
    "image_url", "engagement_rate", "competition_score", "mo_sales", "mo_revenue",
    "total_sales_est", "growth_rate", "niche", "sub_niche",
]

# Shop-API field -> output column (22 fields).
SHOP_FIELDS = {
    "shop_name": "shop_name",
    "shop_id": "shop_id",
    "review_count": "shop_review_count",
    "review_average": "shop_review_avg",
    "transaction_sold_count": "shop_total_sold",
    "shop_age_month": "shop_age_month",
    "shipping_from_country_iso": "ship_from",
    "listing_active_count": "listing_active_count",
    "num_favorers": "shop_favorites",
    "views": "shop_views",
    "revenue": "shop_revenue",
    "revenue_30_days": "shop_revenue_30d",
    "sales_30_days": "shop_sales_30d",
    "conversion_rate": "shop_conversion_rate",
    "review_rate": "shop_review_rate",
    "average_listing_price": "shop_avg_listing_price",
    "sale_per_listing": "shop_sale_per_listing",
    "shop_type": "shop_type",
    "category": "shop_category",
    "url": "shop_url",
    "shop_logo": "shop_logo_url",
    "is_deactivated": "is_deactivated",
}

# Output column order of shops.
SHOP_ORDER = [
    "shop_name", "shop_id", "shop_url", "shop_review_count", "shop_review_avg",
    "shop_review_rate", "shop_total_sold", "shop_age_month", "listing_active_count",
    "shop_favorites", "shop_views", "shop_revenue", "shop_revenue_30d", "shop_sales_30d",
    "shop_conversion_rate", "shop_avg_listing_price", "shop_sale_per_listing", "ship_from",
    "shop_type", "shop_category", "shop_logo_url", "is_deactivated",
]

# Shop-listing-API field -> output column (27 fields).
SHOP_LISTING_FIELDS = {
    "listing_id": "listing_id",
    "title": "title",
    "url": "etsy_url",
    "Images": "image_url",
    "price": "price",
    "state": "state",
    "cached_listing_age_in_months": "listing_age",
    "views": "views",
    "num_favorers": "favorites",
    "review_count": "reviews",
    "cached_est_reviews_in_months": "avg_reviews",
    "transaction_sold_count": "total_sold",
    "listing_active_count": "listing_active_count",
    "main_category": "category",
    "sub_category": "sub_category",
    "listing_type": "listing_type",
    "shipping_from_country_iso": "ship_from",
    "cached_visibility_score": "visibility_score",
    "cached_est_reviews": "est_reviews",
    "when_made": "when_made",
    "who_made": "who_made",
    "is_customizable": "is_customizable",
    "has_variations": "has_variations",
    "est_mo_sales": "mo_sales",
    "est_mo_revenue": "mo_revenue",
    "est_total_sales": "total_sales_est",
    "growth_rate": "growth_rate",
}

# Output column order of shop listings.
SHOP_LISTING_ORDER = [
    "shop_name", "listing_id", "title", "price", "tags", "etsy_url", "image_url",
    "listing_age", "views", "favorites", "reviews", "avg_reviews", "state", "total_sold",
    "visibility_score", "est_reviews", "category", "sub_category", "listing_type", "ship_from",
    "when_made", "who_made", "is_customizable", "has_variations", "mo_sales", "mo_revenue",
    "total_sales_est", "growth_rate",
]

# Sentinel for locked fields, and the columns that carry it in search listings.
LOCKED_TEXT = "Please upgrade"
LOCKED_COLUMNS = ["mo_sales", "mo_revenue", "total_sales_est", "growth_rate", "visibility_score"]

# Rankings asked of the search API, in order (14, of which 12 differ).
RANKINGS = [
    ("views", "desc"), ("views", "asc"), ("est_mo_revenue", "desc"), ("reviews", "desc"),
    ("favorites", "desc"), ("listing_age", "desc"), ("est_reviews", "desc"),
    ("est_reviews_in_months", "desc"), ("transaction_sold_count", "desc"),
    ("listing_age", "asc"), ("transaction_sold_count", "asc"),
    ("est_reviews_in_months", "asc"), ("listing_age", "asc"), ("views", "asc"),
]

# Limits.
API_PAGE_ROWS = 20
API_MAX_PAGES = 500
ENRICH_BATCH_ROWS = 40
MAX_LISTING_IMAGES = 20
MIN_IMAGE_SIDE = 1028
MIN_SEGMENTS = 5
STEEP_DEGREES = 70
DAYS_PER_MONTH = 30.44
CARD_TITLE_CHARS = 60
MAX_QUIET_ROUNDS = 5
BOARD_UTC_HOURS = 7

# Job-posting columns in output order.
JOB_COLUMNS = [
    "title", "detail_title", "job_url", "company", "company_name_full", "company_url",
    "company_url_from_job", "salary_list", "detail_salary", "address_list", "detail_location",
    "exp_list", "detail_experience", "deadline", "tags", "working_addresses", "working_times",
    "desc_mota", "desc_yeucau", "desc_quyenloi", "company_website", "company_size",
    "company_industry", "company_address", "company_description",
]

# Labels and headings looked for on job pages.
JOB_SALARY_LABEL = "Mức lương"
JOB_LOCATION_LABEL = "Địa điểm"
JOB_EXPERIENCE_LABEL = "Kinh nghiệm"
JOB_DEADLINE_WORDS = "Hạn nộp"
JOB_DESCRIPTION_HEADING = "Mô tả công việc"
JOB_REQUIREMENTS_HEADING = "Yêu cầu ứng viên"
JOB_BENEFITS_HEADING = "Quyền lợi"
JOB_ADDRESSES_HEADING = "Địa điểm làm việc"
JOB_TIMES_HEADING = "Thời gian làm việc"

# Words that classify a label on a company page, tried in this order.
COMPANY_LABELS = [
    ("website", ["website", "trang web"]),
    ("size", ["quy mô", "size", "nhân sự"]),
    ("industry", ["lĩnh vực", "industry", "ngành"]),
    ("address", ["địa chỉ", "address"]),
]

# Phrases on pages of listings that are gone, on bot checks, on rate limits.
GONE_PHRASES = [
    "sorry, this item is unavailable", "this item is unavailable", "no longer available",
    "this listing has expired", "page not found", "this shop is on vacation",
]
LIVE_GONE_PHRASES = [
    "is unavailable", "no longer available", "this listing has expired", "page not found",
    "this shop is on vacation", "sold out",
]
ROBOT_PHRASES = [
    "are you a robot", "captcha", "to discuss automated access", "press and hold",
    "verify you are a human",
]
RATE_LIMIT_PHRASES = [
    "429", "Too Many Requests", "too many requests", "rate limit", "Rate Limit", "slow down",
    "Slow Down",
]

# The narrower signs of a rate-limit page, in the title and in the source.
RATE_LIMIT_TITLES = ["429", "too many requests"]
RATE_LIMIT_MARKS = [
    "429 Too Many Requests", "HTTP 429", "<title>429", "too many requests</",
]

# Words in a mock-up file name that tell the garment tone, light tried first.
LIGHT_WORDS = [
    "white", "cream", "ivory", "light", "pale", "sand", "beige", "natural", "off_white",
    "offwhite", "snow", "chalk", "linen", "vanilla", "pearl", "oatmeal", "ash", "trang", "kem",
    "nhat",
]
DARK_WORDS = [
    "black", "dark", "navy", "charcoal", "midnight", "onyx", "ebony", "jet", "forest",
    "hunter", "deep", "graphite", "slate", "indigo", "maroon", "burgundy", "wine", "den", "toi",
    "dam",
]

# Art side markers removed before pairing, in this order.
SIDE_MARKERS = ["_front", "_back", "-front", "-back", "_f_", "_b_"]

# Shape thresholds on width / height.
PORTRAIT_BELOW = 0.77
LANDSCAPE_ABOVE = 1.30

# MIME type by file extension.
MIME_TYPES = {
    ".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp",
}
MIME_DEFAULT = "application/octet-stream"
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp", ".gif"]

# Record-number prefix and letter.
SKU_PREFIX = "NTD"
SKU_LETTER = "A"

# Markup of old-style descriptions.
TITLE_MARK = "**Title:**"
TAGS_MARK = "**Tags:**"
URL_MARK = "**Etsy URL:**"
ID_MARK = "**Listing ID:**"
STATUS_MARK = "**Status:**"
HIDDEN_STATUS = "Unavailable"

# Named character references of HTML; the ampersand comes last.
ENTITIES = [
    ("nbsp", "\u00a0"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("copy", "\u00a9"),
    ("reg", "\u00ae"), ("trade", "\u2122"), ("deg", "\u00b0"), ("times", "\u00d7"),
    ("middot", "\u00b7"), ("bull", "\u2022"), ("ndash", "\u2013"), ("mdash", "\u2014"),
    ("lsquo", "\u2018"), ("rsquo", "\u2019"), ("ldquo", "\u201c"), ("rdquo", "\u201d"),
    ("hellip", "\u2026"), ("euro", "\u20ac"), ("pound", "\u00a3"), ("amp", "&"),
]

# Fixed value: the longest text of a list item that counts as a tag on a page without a tag list.
LONGEST_BARE_TAG = 50
