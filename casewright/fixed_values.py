"""Label domains, word lists, rule tables, the label dictionary and prompt texts.

Everything in this module is data that results depend on word for word. Rule
tables are ordered; the first label whose list has a substring of the text wins.
"""

# ---- label domains -------------------------------------------------------------------------
CANONICAL_LABELS = [
    "Product Defect", "Login", "Billing", "Customer Service", "Delivery", "Performance", "Other",
]
PROMPT_LABEL_ORDER = [
    "Billing", "Login", "Delivery", "Product Defect", "Performance", "Customer Service", "Other",
]
SEVERITIES = ["Low", "Medium", "High"]
SENTIMENTS = ["Positive", "Neutral", "Negative"]
YES_NO = ["Yes", "No"]

# ---- column names --------------------------------------------------------------------------
ID_COLUMN_NAMES = ["ticket_id", "id", "ticketid", "ticket_id_raw", "ticketid_raw"]
TEXT_COLUMN_NAMES = ["subject", "description", "body", "text", "input_text"]
PREDICTION_COLUMN_NAMES = [
    "llm_parsed", "llm_parsed_json", "complaint_type_pred", "complaint_pred_raw",
    "complaint_pred", "pred_complaint_type", "prediction", "pred_complaint", "label_complaint_type", "llm_raw", "raw_pred",
]
PREDICTION_SNIFF_WORDS = [
    "product", "login", "bill", "payment", "customer", "deliver", "perf", "latency", "bug", "issue",
]
COMPARE_COLUMNS = [
    "ticket_id", "clean_text", "label_complaint_type", "complaint_type_pred", "label_severity",
    "severity_pred", "label_sentiment", "sentiment_pred", "label_action_required",
    "action_required_pred", "root_cause_pred",
]
RESPONSE_FIELDS = ["complaint_type", "severity", "sentiment", "root_cause", "action_required"]

# Strings a CSV reader takes as missing.
CSV_NULL_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- label rules ---------------------------------------------------------------------------
COLLAPSE_RULES = [
    ("Billing", ["bill", "payment", "refund", "invoice", "charge"]),
    ("Login", ["login", "auth", "password", "signin", "sign-in", "authentication"]),
    ("Delivery", ["deliver", "shipment", "tracking", "order not", "not arrived", "not received"]),
    ("Performance", ["perf", "latency", "slow", "lag", "timeout", "responsive"]),
    ("Customer Service", ["customer", "support", "service", "agent", "rep", "representative"]),
    ("Product Defect", ["product", "defect", "bug", "crash", "error", "ui", "issue"]),
]
RAG_RULES = [
    ("Billing", ["bill", "payment", "refund", "invoice", "charge"]),
    ("Login", ["login", "auth", "password", "signin", "sign-in", "authentication"]),
    ("Delivery", ["deliver", "shipment", "tracking", "order not", "not arrived"]),
    ("Product Defect", ["product", "defect", "bug", "crash", "issue", "error", "ui", "ux"]),
    ("Performance", ["perf", "latency", "slow", "lag", "timeout", "responsive"]),
    ("Customer Service", ["customer", "support", "service", "agent", "rep"]),
]
INFER_RULES = [
    ("Billing", ["bill", "payment", "refund", "invoice", "charge"]),
    ("Login", ["login", "auth", "password", "signin", "sign-in", "authentication"]),
    ("Delivery", ["deliver", "shipment", "tracking", "order not", "not arrived", "not received"]),
    ("Product Defect", ["product", "defect", "bug", "crash", "error", "ui", "issue"]),
    ("Performance", ["perf", "latency", "slow", "lag", "timeout", "responsive"]),
    ("Customer Service", ["customer", "support", "service", "agent", "rep"]),
]

# ---- severity word lists -------------------------------------------------------------------
CRITICAL_WORDS = [
    "data loss", "lost data", "payment failed", "payment failure", "charged", "fraud",
    "account locked", "cannot access account", "account disabled", "unable to access account",
    "payment denied", "card declined", "credit card declined", "unauthorized", "breach",
    "leak", "exposed", "compromised", "ransom", "hacked", "security breach", "sensitive data",
]
MAJOR_FAULT_WORDS = [
    "not turning on", "won't turn on", "not powering", "no power", "not working",
    "stopped working", "doesn't work", "does not work", "broken", "crash", "crashes", "bricked",
    "unable to use", "can't use", "cannot use", "error", "fatal", "failed to", "not functioning",
    "not responding", "unresponsive", "overheating", "smoke", "burn", "won't boot", "no sound",
    "no display", "battery issue", "battery died", "battery draining", "not charging",
    "firmware update failed", "update failed", "boot loop",
]
BILLING_HIGH_WORDS = [
    "payment failed", "charged", "card declined", "charge", "fraud", "unauthorized",
]
LOGIN_HIGH_WORDS = [
    "account locked", "cannot access", "invalid credentials", "unable to login", "can't login",
    "cannot log in",
]
DELIVERY_HIGH_WORDS = [
    "not received", "not delivered", "missing", "lost", "damaged", "delivered to wrong",
    "never arrived",
]
PERFORMANCE_HIGH_WORDS = ["outage", "down", "not working", "unresponsive", "timeout"]
BILLING_COMPLAINTS = ["billing", "payment", "payment/billing"]
LOGIN_COMPLAINTS = ["login", "account/subscription"]
SERVICE_COMPLAINTS = ["customer service", "customer sdervice"]

# ---- sentiment word lists ------------------------------------------------------------------
POSITIVE_WORDS = [
    "thank", "thanks", "resolved", "fixed", "working fine", "appreciate", "great", "excellent",
    "happy", "satisfied", "awesome", "glad",
]
NEUTRAL_WORDS = [
    "question", "inquiry", "info", "information", "how to", "could you", "please advise",
    "clarify", "details",
]
NEGATIVE_WORDS = [
    "not", "no", "problem", "issue", "error", "failed", "failure", "broken", "hate",
    "disappointed", "complain", "complaint", "angry", "frustrat", "unable", "can't", "cannot",
    "crash", "crashes", "slow", "lag", "doesn't", "does not",
]
SHORT_HELP_WORDS = ["please assist", "help"]
SHORT_HELP_MAX_WORDS = 6

# ---- label dictionary ----------------------------------------------------------------------
LABEL_DICTIONARY = {
    "complaint_mapping": {
        "product defect": "Product Defect",
        "product defect ": "Product Defect",
        "product-defect": "Product Defect",
        "productdefect": "Product Defect",
        "billing/payment": "Billing",
        "billing payment": "Billing",
        "billing": "Billing",
        "refund request": "Refund",
        "refund": "Refund",
        "login/authentication": "Login",
        "login": "Login",
        "authentication": "Login",
        "customer support": "Customer Service",
        "customer service": "Customer Service",
        "customer support ": "Customer Service",
        "technical issue": "Technical Issue",
        "technical": "Technical Issue",
        "other": "Other",
    },
    "severity_mapping": {
        "low": "Low",
        "medium": "Medium",
        "med": "Medium",
        "high": "High",
        "critical": "High",
    },
    "sentiment_mapping": {
        "positive": "Positive",
        "neutral": "Neutral",
        "negative": "Negative",
        "pos": "Positive",
        "neg": "Negative",
    },
}

# ---- redaction marks -----------------------------------------------------------------------
EMAIL_PATTERN = r"\b[\w\.-]+@[\w\.-]+\.\w{2,}\b"
PHONE_PATTERN = r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b"
EMAIL_MARK = "[REDACTED_EMAIL]"
PHONE_MARK = "[REDACTED_PHONE]"

# ---- prompt texts --------------------------------------------------------------------------
ZERO_SHOT_TEMPLATE = """You are a ticket classification assistant. Output MUST be valid JSON (no extra text). Use the exact allowed values for fields.

Allowed complaint_type: ["Billing/Payment","Login?authentication","Delivery","Product Defect","Performance","Customer Service","Other"]
Allowed severity: ["Low","Medium","High"]
Allowed sentiment: ["Positive","Neutral","Negative"]
Allowed action_required: ["Yes","No"]

Instructions:
- Read the ticket text between triple backticks.
- For complaint_type, choose the single best category from allowed values.
- For severity, choose using the rules: High = customer cannot use core functionality or financial loss; Medium = partial degradation; Low = cosmetic or informational.
- For root_cause, return a short phrase (3-6 words) summarizing the likely cause. If unknown, return "Unknown".
- Make values exact (case-sensitive) as allowed above.
- Return ONLY a single JSON object with these keys in this order:
  {"complaint_type": "...", "severity": "...", "sentiment": "...", "root_cause": "...", "action_required": "..."}

Ticket:
```{text}```

Respond now.
"""

RAG_HEADER = """You are a strict ticket classification assistant. Output ONLY a single JSON object (no extra text).
Use keys (case-sensitive): {"complaint_type","severity","sentiment","root_cause","action_required"}.
Allowed complaint_type: ["Billing","Login","Delivery","Product Defect","Performance","Customer Service","Other"].
Allowed severity: ["Low","Medium","High"].
Allowed sentiment: ["Positive","Neutral","Negative"].
Allowed action_required: ["Yes","No"].

Normalization rules:
- Map text containing 'bill' or 'payment' -> Billing
- Map text containing 'login' or 'auth' -> Login
- Map text containing 'deliver' -> Delivery
- Map text containing 'product' or 'defect' -> Product Defect
- Map text containing 'perf' or 'latency' -> Performance
- Map text containing 'customer' or 'support' -> Customer Service
- root_cause: short phrase (1-6 words); if unknown -> "Unknown"

Return only JSON for the ticket you are given below.
"""

INFER_HEADER_FULL = """You are a ticket classification assistant. Output ONLY a single JSON object with fields:
{{"complaint_type","severity","sentiment","root_cause","action_required"}}.
Allowed complaint_type: ["Billing","Login","Delivery","Product Defect","Performance","Customer Service","Other"].
Allowed severity: ["Low","Medium","High"].
Allowed sentiment: ["Positive","Neutral","Negative"].
action_required: "Yes" or "No".
root_cause: short phrase (1-6 words) or "Unknown".

Provide concise answers. Use reasoning only if necessary. Return only the structured JSON via a function call (no extra text).
"""

INFER_HEADER_CHEAP = """You are a structured classification assistant for customer support tickets.

Your task is to classify each ticket into exactly ONE complaint type, ONE severity level, and ONE sentiment.

---

ALLOWED COMPLAINT TYPES:
- Product Defect
- Login
- Billing
- Customer Service
- Delivery
- Performance
- Other

Definitions:

Product Defect:
Hardware malfunction, physical issue, device not working, crashes, overheating, broken components.

Login:
Authentication issues, password errors, account locked, cannot sign in.

Billing:
Charges, refunds, payment failures, incorrect billing, subscription issues.

Customer Service:
Complaints about support agents, poor service, long wait times.

Delivery:
Shipping delays, missing packages, damaged deliveries.

Performance:
App slow, lag, latency, timeout, responsiveness issues.

Other:
Anything that does not clearly match the above.

---

ALLOWED SEVERITY:
- High: Core functionality broken, account inaccessible, payment failed, data loss.
- Medium: Product issue but system partially usable.
- Low: Minor inconvenience or informational request.

---

ALLOWED SENTIMENT:
- Negative
- Neutral
- Positive

---

IMPORTANT RULES:
- Choose ONLY from allowed complaint types.
- Do NOT invent new categories.
- If unsure between two, choose the most specific one.
- If ticket clearly describes hardware malfunction, it MUST be Product Defect.
- If ticket mentions login/authentication failure, it MUST be Login.
- If ticket mentions charges/refund/payment, it MUST be Billing.

---

Return ONLY valid JSON with the following format:

{
  "complaint_type": "...",
  "severity": "...",
  "sentiment": "...",
  "root_cause": "...",
  "action_required": "Yes" or "No"
}

Do not include explanations.
"""
