"""Labels, codes and thresholds that results must reproduce."""

from __future__ import annotations

# fixed values: sentinel dates and their integer keys
UNKNOWN_DATE = "1900-01-01"
OPEN_DATE = "9999-12-31"
UNKNOWN_DATE_KEY = 19000101
OPEN_DATE_KEY = 99991231

# fixed values: text written for missing entries
UNKNOWN = "UNKNOWN"
NOT_SPECIFIED = "Not Specified"
NO_TITLE = "No Title"
NO_MESSAGE = "No Message"
OTHER = "Other"

# fixed values: payment type labels
PAYMENT_LABELS = {
    "credit_card": "Credit Card",
    "debit_card": "Debit Card",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "not_defined": "Not Specified",
}

# fixed values: lead origin labels
ORIGIN_LABELS = {
    "organic_search": "Organic Search",
    "paid_search": "Paid Search",
    "social": "Social",
    "email": "Email",
    "referral": "Referral",
    "display": "Display",
    "direct_traffic": "Direct Traffic",
}

# fixed values: lead type labels
LEAD_TYPE_LABELS = {
    "online_big": "Online Big",
    "online_medium": "Online Medium",
    "online_small": "Online Small",
    "industry": "Industry",
    "offline": "Offline",
}

# fixed values: lead behaviour labels
BEHAVIOUR_LABELS = {"cat": "Cat", "eagle": "Eagle", "wolf": "Wolf", "shark": "Shark"}

# fixed values: business type labels
BUSINESS_TYPE_LABELS = {
    "reseller": "Reseller",
    "manufacturer": "Manufacturer",
    "others": "Other",
}

# fixed values: seeded members of the two static dimensions, numbered from 1
PAYMENT_TYPES = ["Credit Card", "Debit Card", "Boleto", "Voucher", "Not Specified"]
ORDER_STATUSES = [
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "canceled",
    "unavailable",
]

# fixed values: orders with these states never ship
NEVER_SHIPPED = ["canceled", "unavailable"]
APPROVED_STATES = ["approved", "processing", "shipped", "delivered", "invoiced"]
SHIPPED_STATES = ["shipped", "delivered"]

# fixed values: state codes and their map names
STATE_NAMES = {
    "SP": "São Paulo, Brazil",
    "RJ": "Rio de Janeiro, Brazil",
    "MG": "Minas Gerais, Brazil",
    "PR": "Paraná, Brazil",
    "SC": "Santa Catarina, Brazil",
    "RS": "Rio Grande do Sul, Brazil",
    "BA": "Bahia, Brazil",
    "GO": "Goiás, Brazil",
    "DF": "Distrito Federal, Brazil",
    "ES": "Espírito Santo, Brazil",
    "PE": "Pernambuco, Brazil",
    "CE": "Ceará, Brazil",
    "PA": "Pará, Brazil",
    "MT": "Mato Grosso, Brazil",
    "MS": "Mato Grosso do Sul, Brazil",
    "AM": "Amazonas, Brazil",
    "MA": "Maranhão, Brazil",
    "PB": "Paraíba, Brazil",
    "RN": "Rio Grande do Norte, Brazil",
    "AL": "Alagoas, Brazil",
    "PI": "Piauí, Brazil",
    "SE": "Sergipe, Brazil",
    "RO": "Rondônia, Brazil",
    "TO": "Tocantins, Brazil",
    "AC": "Acre, Brazil",
    "AP": "Amapá, Brazil",
    "RR": "Roraima, Brazil",
}
NORTH_STATES = ["AM", "PA", "AC", "RO", "RR", "AP", "TO"]
HOME_STATE = "SP"

# fixed values: measure constants
DELIVERY_TARGET_DAYS = 12
SCORE_TARGET = 4.0
FORECAST_PERIODS = 3
OPTIMISTIC_FACTOR = 1.15
PESSIMISTIC_FACTOR = 0.90
SLOW_DELIVERY_DAYS = 15
LOW_SCORE = 3.8
HIGH_CANCELLATION = 0.05
REVENUE_DROP = -0.05

# fixed values: seller score weights
SELLER_WEIGHTS = {
    "avg_review_score": 0.35,
    "pct_on_time": 0.30,
    "total_revenue": 0.20,
    "total_orders": 0.15,
}

# fixed values: day from which recency is counted, and the churn cut-off in days
ANCHOR_DATE = "2018-10-17"
CHURN_DAYS = 180
