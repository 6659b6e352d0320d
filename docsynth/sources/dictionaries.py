"""Literal word lists and helpers that turn tables into lookup dictionaries.

Name and address data are inputs (DataFrames), not bundled libraries:
``first_names(name, gender, weight)``, ``last_names(name, weight)``,
``indian_names(name, gender)``, ``addresses(address1, address2, city, state,
postalCode)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# E-mail domains, in the reference's order.
EMAIL_DOMAINS = [
    "gmail.com", "outlook.com", "tutanota.com", "gmx.com", "yahoo.com",
    "aol.com", "mail.com", "zoho.com", "protonmail.com", "mailerlite.com",
    "ukr.net", "mail.ru", "yandex.ru",
]
DEFAULT_EMAIL_DOMAIN = "gmail.com"

# Separators between e-mail user-name parts (the last is empty).
EMAIL_SEPARATORS = [".", "-", "_", ""]

# Company-name words ("Tech" is in both lists).
COMPANY_ADJECTIVES = [
    "Tech", "Innovative", "Global", "Creative", "Dynamic",
    "Smart", "Agile", "Bright", "NexGen", "Fusion",
]
COMPANY_NOUNS = [
    "Solutions", "Labs", "Systems", "Tech", "Group", "Enterprises",
    "Innovations", "Digital", "Networks", "Ventures",
]


