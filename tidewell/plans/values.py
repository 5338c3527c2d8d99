"""Codes, labels, limits and lists that the reports must show or test as they are."""

from __future__ import annotations

# Policy status codes.
IN_FORCE = ("1", "2", "3", "4", "5", "7", "9")
PENDING = ("6", "8")
PAYING = ("1", "2", "3", "5")
APP_PAYING = ("1", "3", "5", "7")
ORIGINAL_HOLDING = ("1", "2", "3", "5", "7", "9")
NOT_SOLD = ("8", "A", "N", "R", "X")
NOT_COUNTED = ("A", "N", "R")

STATUS_TEXT = {
    "1": "Premium Paying",
    "2": "Premium Waiver",
    "3": "Fully Paid",
    "4": "Extended Term Ins.",
    "5": "Reduced Paid-Up",
    "6": "Pending for premium",
    "7": "Support premium",
    "8": "NB Pending",
    "9": "Support premium",
    "A": "Not taken",
    "B": "Lapsed",
    "C": "Converted",
    "D": "Death Claimed",
    "E": "Surrendered",
    "F": "Matured",
    "H": "Expired",
    "L": "Deleted",
    "M": "MDR Claim",
    "N": "Not taken",
    "R": "Rejected",
    "T": "TPD Claim",
    "X": "Closed",
}

RELATION_TEXT = {
    0: "Others",
    1: "Self",
    2: "Spouse",
    3: "Child",
    4: "Others",
    5: "Others",
    10: "Others",
    31: "Others",
    51: "Parent",
    52: "Others",
}

PAYMENT_MODE_TEXT = {1: "monthly", 3: "quarterly", 6: "half-yearly", 12: "yearly"}

# Status movement: label of each bucket, and the current statuses that close an in-force policy.
MOVE_OPENING = "00.Beginning balance (Non MI)"
MOVE_NEW = "01.New Business Issuance"
MOVE_REINSTATED = "02.Reinstatement"
MOVE_UNISSUED = "03.Unissue"
MOVE_LAPSED = "04.Lapsed"
MOVE_SURRENDERED = "05.Surrender"
MOVE_MATURED = "06.Maturity"
MOVE_CLAIMED = "07.Death-Major Disease-TPD"
MOVE_NOT_TAKEN = "08.Nottaken"
MOVE_OTHER = "09.Other Terminated Status"
MOVE_CLOSING = "10.Ending balance (Non MI)"
MOVE_CLOSING_EXCLUDED = "11.Ending balance (MI)"
MOVE_EXITS = {
    MOVE_UNISSUED: ("6", "8"),
    MOVE_LAPSED: ("B",),
    MOVE_SURRENDERED: ("E",),
    MOVE_MATURED: ("F", "H"),
    MOVE_CLAIMED: ("D", "M", "T"),
    MOVE_NOT_TAKEN: ("A",),
    MOVE_OTHER: ("C", "L", "N", "R", "X"),
}
LAPSE_AGES = ("1.Within 1 year", "2.Within 2 years", "3.>2 years")
EXCLUDED_PLAN = "MI007"

# Agents.
OPEN_LOCATION = "Open Location"
CONTACT_PROVIDERS = ("01", "02", "08", "98", "12", "94", "95", "96", "97")
CHANNEL_TEXT = {"BK": "Bancassurance", "DR": "DMTM", "AGT": "Agency"}
LOCATION_CHANNEL_TEXT = {
    "AGT": "Agency",
    "MGA": "Agency",
    "BK": "Banca",
    "BR": "Banca",
    "DR": "DMTM",
    "MI": "MI",
}
APP_CHANNEL_TEXT = {"AGT": "Agency", "DR": "DMTM", "BK": "Banca"}

# Distribution channel codes by the margin they earn.
OTHER_BANK_CHANNELS = (
    "03", "10", "14", "16", "17", "18", "19", "22", "23", "24", "25", "29", "30", "31", "32",
    "33", "39", "41", "44", "47", "49", "51", "52", "53",
)
AFFINITY_CHANNELS = ("48",)
AGENCY_CHANNELS = ("01", "02", "08", "50", "*")
DIRECT_CHANNELS = ("05", "06", "07", "34", "36")
LOAN_CHANNELS = ("09",)
LEAD_LOAN_MARGIN = "-1.34041044648343"
ECOMMERCE_LOAN_MARGIN = "-1.34"
BANK_PREFIX_MARGINS = {
    "TCB": "nbv_margin_banca_tcb",
    "SAG": "nbv_margin_banca_scb",
    "VTI": "nbv_margin_banca_vti",
}
LEAD_EXCLUDED_PLAN_PREFIXES = ("FDB", "BIC", "NP0")
ECOMMERCE_PLANS = ("FDB01", "BIC01", "BIC02", "BIC03", "BIC04", "PN001")

# Payments.
VOUCHER_BANK = "SHOPEEVC"
ONLINE_BANKS = ("SHOPEEVC", "ECOMSACB", "SCBHCMC")
ONLINE_SERVICE_TYPES = ("6", "8")
VENDOR_RECEIPT_UNTIL = "2021-04-14"
CASH_ACCOUNT = "PCCASH"
NO_PLAN = "55550"
LEDGER_TYPES = ("N", "X", "A")

# Sales.
FYP_WEIGHTS = {"FYP": "1", "FYP-TOPUP": "0.06", "SP": "0.06"}

# Bands.
AGE_EDGES = (18, 25, 35, 45, 55, 65)
AGE_LABELS = ("1.18-24", "2.25-34", "3.35-44", "4.45-54", "5.55-64")
PREMIUM_EDGES = (None, 10000, 20000, 40000, 65000, 80000, 150000, 250000, None)
PREMIUM_LABELS = (
    "1.less than 10",
    "2.10 - less than 20",
    "3.20 - less than 40",
    "4.40 - less than 65",
    "5.65 - less than 80",
    "6.80 - less than 150",
    "7.150 - less than 250",
    "8.250 and above",
)
TENURE_EDGES = (None, 1, 2, 3, 4, 5, 6, 10, None)
TENURE_LABELS = (
    "1.less than 1 year",
    "2.1 year to less than 2 years",
    "3.2 years to less than 3 years",
    "4.3 years to less than 4 years",
    "5.4 years to less than 5 years",
    "6.5 years to less than 6 years",
    "7.6 years to less than 10 years",
    "8.10 years or more",
)
RECENCY_EDGES = (None, 1, 2, 3, 4, 5, 6, 7, 10)
RECENCY_LABELS = (
    "1.less than 1 year",
    "2.1 year to less than 2 years",
    "3.2 years to less than 3 years",
    "4.3 years to less than 4 years",
    "5.4 years to less than 5 years",
    "6.5 years to less than 6 years",
    "7.6 years to less than 7 years",
    "8.7 years to less than 10 years",
)
RECENCY_DEFAULT = "9.10 years or above"
KPI_TENURE_EDGES = (None, 1, 2, 3, 4, 5, 10)
KPI_TENURE_LABELS = (
    "<1 year",
    "1<= year <2",
    "2<= year <3",
    "3<= year <4",
    "4<= year <5",
    "5<= year <10",
)
KPI_TENURE_DEFAULT = ">10 years"
INCOME_EDGES = (None, 10000, 20000, 40000, 60000, 80000)
INCOME_LABELS = ("<10 mil", "10mil - <20 mil", "20mil - <40 mil", "40mil - <60 mil", "60mil - <80 mil")
INCOME_DEFAULT = ">80 mil"
NEEDS = {
    "accident": "need_acc",
    "critical_illness": "need_ci",
    "disability": "need_dis",
    "group_life_health": "need_glh",
    "investment_linked": "need_inv",
    "life_protection": "need_lp",
    "long_term_savings": "need_lts",
    "medical": "need_med",
}

ENRICHED_TIERS = {
    "Silver": "4.Silver",
    "Gold": "3.Gold",
    "Platinum": "2.Platinum",
    "Platinum Elite": "1.Platinum Elite",
    "Not VIP": "5.Not VIP",
}

# City names of the monthly premium report; other cities are 'Others'.
CITY_TEXT = {
    "HN": "Hà Nội",
    "HCM": "Hồ Chí Minh",
    "Hà Nội": "Hà Nội",
    "Hồ Chí Minh": "Hồ Chí Minh",
    "Đà Nẵng": "Đà Nẵng",
    "Hải Phòng": "Hải Phòng",
    "Cần Thơ": "Cần Thơ",
}

# Campaign pages by the part of the address that names them.
PAGE_TEXT = {
    "customerportfoliomanagement": "CPM Landing Page",
    "newcustomerpolicys": "Lead List Page",
    "customerpotentiallist": "Lead List Page",
    "customerpolicysdetail": "Lead Info Page",
}

# Product groups: plan codes first, then what the plan's name holds.
PRODUCT_CODE_GROUPS = (
    (
        "Education",
        (
            "EDB10", "EDB11", "EDB12", "EDB13", "EDB14", "EDB15", "EDB16", "EDB17", "EDB18",
            "EDB19", "EDB20", "EDB21", "EDB22", "EDB23", "EDB24", "EDB25", "EDB26", "EDB27",
            "EDF23", "EDF24", "EDF25", "EDF26", "EDF27",
        ),
    ),
    (
        "2018 CI Endowment",
        ("ENC12", "ENC15", "ENC20", "ENF12", "ENF15", "ENF20", "ENM12", "ENM15", "ENM20"),
    ),
    ("CIE", ("EIC12", "EIC15", "EIC20", "EIF12", "EIF15", "EIF20", "EIM12", "EIM15", "EIM20")),
    ("RPVL (Unit-linked)", ("RUV01", "RUV02", "RUV03")),
    ("New ILP", ("RUV04", "RUV05", "RUV06", "RUV07")),
    ("Universal Life 2019", ("UL038", "UL039", "UL040", "UL041")),
    ("Cancer360", ("CA360",)),
    ("Term ROP", ("RPA03", "RPA05", "RPA10", "RPB03", "RPB05", "RPB10")),
    ("AUL", ("UL035", "UL036", "UL037")),
    ("2015 Universal Life", ("UL007",)),
)
BANK_UNGROUPED = ("New ILP", "Billion Cash")
PARTNER_USER = "SHOPEE"
PARTNER_GROUP = "Shopee"
PARTNER_PLAN = "FDB01"
PARTNER_VERSIONS = ("07", "08", "09")
CASH_GROUP = "Billion Cash"
CASH_PLANS = ("BIC01", "BIC02", "BIC03", "BIC04")
NAME_GROUPS = (
    ("universal life", "Universal Life"),
    ("education", "Education"),
    ("my life", "My Life"),
    ("my family", "My Family"),
    ("premier care", "Premier Care"),
    ("premier lady", "Premier Lady"),
    ("savings", "Savings"),
    ("endowment", "Endowment"),
    ("flexible en", None),
    ("accident", "Accident"),
    ("term premium", "Term Premium"),
)
FLEXIBLE_SUFFIX = 3

# Weekly operations: who entered the policy, and the plans sold through one bank channel.
ENTRY_USERS = {"EPOS": "ePOS", "SHOPEE": "Shopee"}
ENTRY_USERS_DETAIL = {"EPOS": "ePOS", "SHOPEE": "Shopee", "ECOMMERCE": "Ecommerce"}
DIGITAL_USERS = ("EPOS", "SHOPEE", "ECOMMERCE")
CANCER_PLANS = ("CA360", "CX360")
CANCER_CHANNEL = "24"
CANCER_TEXT = "Cancer360"
PAPER_TEXT = "Paper"

# Agent tiers.
NEXT_TIER = {"Platinum": "MDRT", "MDRT": "COT", "COT": "TOT", "TOT": "TOT"}
TIER_TARGETS = {"MDRT": 721626600, "COT": 2164879800, "TOT": 4329759600}
BASE_TIER = "Platinum"
QUALIFY_PREMIUM = 600000000
QUALIFY_POLICIES = 30
QUALIFY_ACTIVE_MONTHS = 6

# Monthly customer table: columns no longer measured, kept with their last text.
RETIRED_COLUMNS = {
    "cws_180_act": "NaN",
    "move_180_act": "NaN",
    "e_pmt_180_act": "NaN",
    "e_clm_180_act": "NaN",
}
APP_KPI = "move_registration"
REPORT_CURRENCY = "78"
