"""Lookup tables. They must be these for right results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that say nothing about which page is meant.
JUNK_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "ref", "s", "amp"]

#: Month names in the order in which they are looked for.
SINHALA_MONTHS = [
    ("ජනවාරි", 1), ("පෙබරවාරි", 2), ("මාර්තු", 3), ("අප්‍රේල්", 4), ("අප්රේල්", 4), ("මැයි", 5), ("ජූනි", 6), ("ජුනි", 6), ("ජූලි", 7), ("ජුලි", 7),
    ("අගෝස්තු", 8), ("සැප්තැම්බර්", 9), ("සැප්තැම්", 9), ("ඔක්තෝබර්", 10), ("නොවැම්බර්", 11), ("දෙසැම්බර්", 12),
]
TAMIL_MONTHS = [
    ("ஜனவரி", 1), ("பிப்ரவரி", 2), ("மார்ச்", 3), ("ஏப்ரல்", 4), ("மே", 5), ("ஜூன்", 6), ("ஜூலை", 7), ("ஆகஸ்ட்", 8), ("செப்டம்பர்", 9),
    ("அக்டோபர்", 10), ("நவம்பர்", 11), ("டிசம்பர்", 12),
]
#: Markers of the forenoon, looked for first, and of the afternoon.
AM_MARKERS = ["පෙ.ව", "පෙව", "முற்பகல்", "காலை", "am"]
PM_MARKERS = ["ප.ව", "පව", "பிற்பகல்", "மாலை", "இரவு", "pm"]

#: Seconds of the units of relative dates.
RELATIVE_UNITS = {"sec": 1, "second": 1, "min": 60, "minute": 60, "hr": 3600, "hour": 3600, "day": 86400, "week": 604800}

#: Rank of the connectors, best first.
ADAPTERS = ["rss", "newsfirst", "wordpress", "sitemap", "html", "google"]

#: Buckets of the bucketed JSON API that name a subject.
BUCKET_CATEGORIES = {"sportPost": "sports", "worldPost": "international", "businessPost": "business"}

#: Section names, as normalised terms, by category.
CATEGORY_TERMS = {
    "sports": ["sports", "sport", "sports-news", "sports news", "cricwire", "olympic", "cricket", "ක්‍රීඩා", "விளையாட்டு"],
    "business": [
        "business", "business-news", "business news", "economy", "general economy", "markets", "finance", "fiscal", "monetary", "banking", "trade",
        "bizwire", "biz talk", "stock watch", "stocks & companies", "bonds & forex", "shipping", "logistics", "aviation", "tourism", "energy",
        "construction and real estate", "ගණුදෙනු ලොව", "ව්‍යාපාර", "வணிகம்",
    ],
    "politics": ["politics", "political news", "election", "දේශපාලන", "அரசியல்"],
    "tech": ["tech", "technology", "sci-tech", "science-and-tech", "science and technology", "තාක්ෂණ", "தொழில்நுட்பம்"],
    "international": ["world", "international", "international news", "international-news", "international relations", "foreign", "විදෙස්", "විදේශ", "உலகம்", "சர்வதேசம்"],
    "entertainment": ["entertainment", "cinema", "music", "සිනමා", "විනෝදාස්වාද", "திரைப்படம்", "சினிமா"],
    "society": ["health", "education", "eduwire", "human rights", "legal", "environment", "සෞඛ්‍ය", "අධ්‍යාපන", "சுகாதாரம்", "கல்வி"],
}

#: Parts of date texts: month names in short, in three languages.
SHORT_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec ජන පෙබ මාර් අප්‍රේ මැයි ජූනි ජූලි අගෝ සැප් ඔක් නොවැ දෙසැ ஜன பிப் மார் ஏப் மே ஜூன் ஜூலை ஆக செப் அக் நவ டிச".split()

#: Sitemap places to try after those that robots.txt names.
SITEMAP_GUESSES = ["news-sitemap.xml", "sitemap-news.xml", "sitemap_news.xml", "news.xml", "sitemap.xml"]

#: Places that a site is probed at.
PROBE_PATHS = [("homepage", ""), ("wp-json", "/wp-json/wp/v2/posts?per_page=1"), ("feed", "/feed"), ("rss.xml", "/rss.xml"), ("rss.php", "/rss.php"), ("robots", "/robots.txt"), ("sitemap", "/sitemap.xml"), ("news-sm", "/news-sitemap.xml")]


def literal_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def term_map() -> Column:
    return literal_map([(t, c) for c, terms in CATEGORY_TERMS.items() for t in terms])
