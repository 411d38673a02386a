"""Marketing channel classification from traffic source and medium."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel labels and the medium/source vocabularies of the rule.
PAID_MEDIUMS = ("cpc", "ppc", "paid")
SOCIAL_SOURCES = ("facebook", "twitter", "instagram")
CHANNELS = (
    "Direct", "Paid Search", "Organic Search", "Paid Social", "Organic Social",
    "Email", "Referral", "Affiliate", "Other",
)


def channel(source: Column | str, medium: Column | str) -> Column:
    """Searched CASE over lower-cased source/medium; first matching rule wins.

    NULL source or medium is treated as the empty string, so a row with
    neither lands in ``Other`` (not ``Direct``).
    """
    s = F.lower(F.coalesce(F.col(source) if isinstance(source, str) else source, F.lit("")))
    m = F.lower(F.coalesce(F.col(medium) if isinstance(medium, str) else medium, F.lit("")))
    paid = m.isin(*PAID_MEDIUMS)
    google = s.contains("google")
    facebook = s.contains("facebook")
    social = facebook
    for other in SOCIAL_SOURCES[1:]:
        social = social | s.contains(other)
    return (
        F.when((s == "(direct)") & (m == "(none)"), "Direct")
        .when(paid & google, "Paid Search")
        .when((m == "organic") & google, "Organic Search")
        .when(paid & facebook, "Paid Social")
        .when(social, "Organic Social")
        .when(m == "email", "Email")
        .when(m == "referral", "Referral")
        .when(m == "affiliate", "Affiliate")
        .otherwise("Other")
    )
