"""Product catalogue, feature windows and fixed business constants."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class ProductSpec:
    """Everything that varies between products in the cohort / feature plans.

    ``task_ids``         field-task ids that count as a "push" for the product
    ``order_date_col``   column of the application table holding the order date
    ``statuses``         application statuses that count (case and blank sensitive)
    ``events``           app event names that make up the product's sessions
    ``session_years``    calendar years the training session extract covers
    ``has_vintage``      whether the training extract computes vintage
    ``application_table``  logical table of the product's applications
    ``profile_date_col``   the mart's date of the product that the training matrix carries, if any
    """

    name: str
    task_ids: tuple = (16,)
    order_date_col: str = "order_date"
    statuses: tuple = ("ORDERED", "ACTIVE")
    events: tuple = ()
    session_years: tuple = (2020, 2021, 2022)
    has_vintage: bool = True
    application_table: str = "application"
    profile_date_col: str | None = None
    event_pattern: str | None = None  # e.g. "speaker": names discovered by LIKE
    date_floor: dt.date = dt.date(2018, 1, 1)  # history floor of every cohort query


# ---------------------------------------------------------------------------
# Fixed values that must equal the source pipeline's for identical results.
# They are stated as text, in their natural order, and never derived.
# ---------------------------------------------------------------------------

# Event names per product (scoring session extract; the speaker list repeats
# some names, which is harmless under IN / isin semantics).
SWIPE_EVENTS = (
    "swipe_home_screen_landed",
    "swipe_od_screen_landed",
    "swipe_home_button_click_order_now",
    "swipe_od_button_click_submit",
    "bharat_swipe",
)
LOAN_EVENTS = (
    "Loan_Enter_Pan_Page",
    "Loan_Eligible_Page",
    "Loan_Agreement_Page",
    "Loan_Enach_Page",
    "loans",
    "loan",
    "credit-score",
)
SPEAKER_EVENTS = (
    "bharatpe_speaker|bharatpe_speaker|speaker_home|faqs",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|onboarding_video|onboarding_video",
    "speaker_place_order_clicked",
    "bharatpe_speaker|bharatpe_speaker|address_details|address_selection|new_address",
    "bharatpe_speaker|bharatpe_speaker|track_order|track_order",
    "bharatpe_speaker|bharatpe_speaker|transactions|select_dates",
    "speaker_payment_success",
    "speaker_gst_landed",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|terms and conditions|terms and conditions",
    "speaker_confirm_address_clicked",
    "speaker_address_landed",
    "bharatpe_club2|bharatpe_club2|club_home|speaker_free|know_more",
    "speaker_payment_success",
    "bharatpe_speaker|bharatpe_speaker|speaker_home|recent_trasactions|view_all",
    "bharatpe_speaker|bharatpe_speaker|transaction_pending",
    "speaker_address_landed",
    "bharatpe_speaker|bharatpe_speaker|speaker_home|speaker_home",
    "speaker_place_order_clicked",
    "speaker_new_address_clicked",
    "bharatpe_speaker",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|hero_introduction|order_now",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|hero_introduction",
    "speaker_payment_landed",
    "speaker_gst_landed",
    "speaker_confirm_address_clicked",
    "bharatpe_speaker|bharatpe_speaker|address_details|address_selection|OGL",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|join_club|join_club",
    "speaker_order_now_landed",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|faqs",
    "speaker_payment_landed",
    "BharatPe Speaker",
    "bharatpe_speaker|bharatpe_speaker|transactions",
    "bharatpe_club2|bharatpe_club2|benefits_details|speaker_free_modal|ok_cta",
    "bharatpe_speaker|bharatpe_speaker|new_merchant_home|intro_video|intro_video",
    "bharatpe_club2|bharatpe_club2|benefits_details|speaker_free|know_more",
    "bharatpe_speaker|bharatpe_speaker|transaction_success_flag",
    "bharatpe_speaker|bharatpe_speaker|invoices",
    "bharatpe_speaker|bharatpe_speaker|language",
    "bharatpe_speaker|bharatpe_speaker|transaction_failed",
    "speaker_join_club_clicked",
    "bharatpe_speaker|bharatpe_speaker|speaker_home|service_request",
    "bharatpe_speaker|bharatpe_speaker|share_cta|share_cta",
    "speaker_order_now_landed",
    "bharatpe_speaker|bharatpe_speaker|address_details|address_selection|address_card",
    "bharatpe_speaker|bharatpe_speaker|language|radio_button",
    "bharatpe_speaker|bharatpe_speaker|transaction_success",
    "bharatpe_speaker|bharatpe_speaker|speaker_home|unboxing_video",
    "bharatpe_speaker",
    "BharatPe Speaker",
    "bharatpe_speaker|bharatpe_speaker|speaker_home|invoices",
    "speaker_new_address_clicked",
    "bharatpe_speaker|bharatpe_speaker|track_order|track_status_cta",
    "bharatpe_speaker|bharatpe_speaker|address_details|address_confirmation|confirm_address",
    "bharatpe_speaker|bharatpe_speaker|invoices|select_invoice",
    "bharatpe_speaker|bharatpe_speaker|speaker_home|laguage",
    "speaker_join_club_clicked",
)
CLUB_EVENTS = ("bharatpe_club", "club_home_screen_visited", "club_benefits_screen_pay")
FP_EVENTS = ("interest_account_page_visit", "interest_account_otp_visit", "interest_account")
CARD_EVENTS = (
    "BPCD_Pan_pin_Page",
    "BPCD_Enach_Page",
    "BPCD_Credit_offer_Page",
    "BPCD_Debit_offer_Page",
    "bpb_card_upi_transaction_settlement_visited",
    "bpb_card_order_click",
    "bharatpe-card",
    "card",
    "card-offer",
)

# Installed apps that mark a merchant as digitally active.
RELEVANT_APPS = (
    "PhonePe",
    "Paytm",
    "GPay",
    "PhonePe Business",
    "Paytm for Business",
    "Google Pay for Business",
    "WhatsApp\xa0Business",
    "Bajaj Finserv",
    "Duo",
    "Khatabook",
    "Kotak Bank",
    "HDFC Bank",
    "CRED",
    "Axis Mobile",
    "MobiKwik",
    "iMobile Pay",
    "OkCredit",
    "BHIM",
    "Amazon Pay for Business",
    "LinkedIn",
)

# Device manufacturer clean-up: aliases and the fixed scoring brand list.
MANUFACTURER_ALIASES = {
    "tecno mobile limited": "tecno",
    "infinix mobility limited": "infinix",
    "hmd global": "hmd",
    "itel mobile limited": "itel",
}
MAJOR_BRANDS = (
    "vivo",
    "samsung",
    "other",
    "xiaomi",
    "oppo",
    "realme",
    "oneplus",
    "apple",
    "motorola",
    "tecno",
    "huawei",
    "infinix",
    "hmd",
    "lge",
    "lenovo",
    "asus",
    "itel",
    "google",
    "lava",
    "micromax",
)

# Recommendation thresholds (probability minus threshold ranks products).
THRESHOLDS = {"loan": 0.6, "swipe": 0.7, "speaker": 0.7}
RANK_ORDER = ("loan", "swipe", "speaker")  # tie order of the ranking

# Digital channel rule: relevant apps >= 4 and weekly sessions >= 480.
CHANNEL_MIN_RELEVANT_APPS = 4
CHANNEL_MIN_W1_SESSIONS = 480

# Active base: >= 5 distinct successful transactions and >= 150 value in 90 days.
ACTIVE_MIN_TXNS = 5
ACTIVE_MIN_TPV = 150
ACTIVE_DAYS = 90

# Floor applied to every "created_at"-style date in the cohort queries.
DATE_FLOOR = dt.date(2018, 1, 1)

# Boosted-tree settings of the propensity models.
GBT_PARAMS = dict(max_iter=150, max_depth=6, step_size=0.1, feature_subset="0.8", subsampling_rate=1.0)

# Threshold sweep of the evaluation table: 0.20, 0.25, ... 0.85.
SWEEP_THRESHOLDS = tuple(round(t / 100, 2) for t in range(20, 90, 5))

PRODUCTS = {
    "swipe": ProductSpec(
        name="swipe",
        application_table="application_swipe",
        profile_date_col="swipe_order_date",
        task_ids=(16,),
        order_date_col="order_date",
        statuses=("ORDERED", "ACTIVE"),
        events=SWIPE_EVENTS,
        session_years=(2020, 2021, 2022),
        has_vintage=True,
    ),
    "speaker": ProductSpec(
        name="speaker",
        application_table="application_speaker",
        profile_date_col="speaker_order_date",
        task_ids=(27,),
        order_date_col="order_date",
        statuses=("ORDERED", "ACTIVE"),
        events=SPEAKER_EVENTS,
        session_years=(2021, 2022),
        has_vintage=True,
        event_pattern="speaker",
    ),
    "loan": ProductSpec(
        name="loan",
        application_table="application_loan",
        task_ids=(18, 21, 22),
        order_date_col="agreement_at",
        statuses=("APPROVED", "approved", "Approved", "rejected", "pending_verification"),
        events=LOAN_EVENTS,
        session_years=(2020, 2021, 2022),
        has_vintage=True,
    ),
    "club": ProductSpec(
        name="club",
        application_table="application_club",
        profile_date_col="club_start_date",
        task_ids=(30,),
        order_date_col="created_at",
        statuses=("ACTIVE", "INIT", "INIT "),
        events=CLUB_EVENTS,
        has_vintage=False,
    ),
    "fp": ProductSpec(
        name="fp",
        application_table="application_fp",
        task_ids=(3,),
        order_date_col="created_at",
        statuses=("APPROVED", "INPROCESS", "SUBMITTED", "INIT"),
        events=FP_EVENTS,
        has_vintage=False,
    ),
    "card": ProductSpec(
        name="card",
        application_table="application_card",
        task_ids=(4,),
        order_date_col="created_at",
        statuses=("APPROVED", "NA"),
        events=CARD_EVENTS,
        has_vintage=False,
    ),
}

# ---------------------------------------------------------------------------
# Settings for the driver's synthetic tables (see FIXTURES.md).
# ---------------------------------------------------------------------------
FIXTURE_AS_OF = dt.date(2001, 8, 1)
FIXTURE_EVENT_SHIFT_DAYS = 8218
FIXTURE_SESSION_RANGE = (dt.date(2001, 1, 1), dt.date(2002, 1, 1))
FIXTURE_CHANNEL_MIN_RELEVANT_APPS = 2
FIXTURE_CHANNEL_MIN_W1_SESSIONS = 15
FIXTURE_ACTIVE_MIN_TXNS = 25

# The synthetic history starts in 2000, so its floor is 2000-01-01 (the
# production floor of 2018 would leave every cohort empty).
FIXTURE_DATE_FLOOR = dt.date(2000, 1, 1)
FIXTURE_PRODUCTS = {
    "swipe": ProductSpec(
        name="swipe", task_ids=(16,), events=("signup", "view"), date_floor=FIXTURE_DATE_FLOOR, profile_date_col="swipe_order_date"
    ),
    "loan": ProductSpec(name="loan", task_ids=(16,), events=("purchase",), date_floor=FIXTURE_DATE_FLOOR),
    "speaker": ProductSpec(name="speaker", task_ids=(16,), events=("click", "error"), date_floor=FIXTURE_DATE_FLOOR),
}
FIXTURE_SPEC = FIXTURE_PRODUCTS["swipe"]

# All six products as in production, on application views of their own: the least quantity of
# the view's line items, the view's date column besides created_at, and its statuses in turn
# (the last one does not count).
FIXTURE_CATALOGUE = {k: replace(v, date_floor=FIXTURE_DATE_FLOOR) for k, v in PRODUCTS.items()}
FIXTURE_APPLICATIONS = {
    k: (10 + 4 * n, v.order_date_col if v.order_date_col != "created_at" else None, (*v.statuses, "REFUSED"))
    for n, (k, v) in enumerate(PRODUCTS.items())
}
# Task ids of the field-task views besides 16.
FIXTURE_TASK_IDS = (18, 27, 30, 3, 4, 21, 22)


@dataclass(frozen=True)
class Window:
    """Half-open day window ``[anchor - start, anchor - end)``; start None = unbounded."""

    name: str
    start: int | None
    end: int = 0


WINDOWS = {
    "w1": Window("w1", 7, 0),
    "w2": Window("w2", 14, 7),
    "w3": Window("w3", 21, 14),
    "m1": Window("m1", 30, 0),
    "m2": Window("m2", 60, 30),
    "m3": Window("m3", 90, 60),
    "90d": Window("90d", 90, 0),
    "total": Window("total", None, 0),
}


@dataclass(frozen=True)
class FeatureFamily:
    measure: str
    windows: tuple = field(default_factory=tuple)


# The 35 rolling features, in output order.
PAYER_WINDOWS = ("w1", "w2", "m1", "m2", "m3", "90d", "total")
TXN_WINDOWS = ("w1", "w2", "w3", "m1", "m2", "m3", "90d", "total")
TPV_WINDOWS = ("w1", "w2", "m1", "m2", "m3", "90d", "total")
MONTH_WINDOWS = ("m1", "m2", "m3")


def feature_name(measure: str, window: str) -> str:
    """``w1_tpv``, ``tpv_90_days``, ``total_tpv`` style names."""
    if window == "90d":
        return f"{measure}_90_days"
    return f"{window}_{measure}"


ROLLING_FEATURES = (
    [feature_name("unique_payers", w) for w in PAYER_WINDOWS]
    + [feature_name("txn_count", w) for w in TXN_WINDOWS]
    + ["total_active_vintage"]
    + [feature_name("tpv", w) for w in TPV_WINDOWS]
    + [feature_name("active_days", w) for w in MONTH_WINDOWS]
    + [feature_name("max_daily_tpv", w) for w in MONTH_WINDOWS]
    + [feature_name("max_daily_payees", w) for w in MONTH_WINDOWS]
    + [feature_name("max_daily_txns", w) for w in MONTH_WINDOWS]
)

RATIO_FEATURES = (
    ("m1_atv", "m1_tpv", "m1_txn_count"),
    ("m2_atv", "m2_tpv", "m2_txn_count"),
    ("total_atv", "total_tpv", "total_txn_count"),
    ("txn_activeday", "total_txn_count", "total_active_vintage"),
    ("m1_txn_activeday", "m1_txn_count", "m1_active_days"),
    ("m2_txn_activeday", "m2_txn_count", "m2_active_days"),
    ("m1_max_daily_by_tpv", "m1_max_daily_tpv", "m1_tpv"),
    ("m1_max_daily_by_payees", "m1_max_daily_payees", "m1_unique_payers"),
    ("m1_max_daily_by_txns", "m1_max_daily_txns", "m1_txn_count"),
)

CATEGORICAL_FEATURES = ("zone_name", "business_category", "trend", "geohash4", "manufacturer")
LOCATION_FEATURES = ("loc_hash_density", "loc_hash_atv", "loc_hash_tpv")
