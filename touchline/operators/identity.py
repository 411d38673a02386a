"""Identity stitching: devices (``user_pseudo_id``) that share accounts (``user_id``) are one user.

Devices and accounts are a bipartite graph with a link for every sign-in that was seen; a stitched user is
a connected component of it.  An account on more than ``most_devices`` devices (a shop's tablet, a test
login) is a hub: it says nothing about who is using a device and links none.

Components are found by contraction.  A round's links are (account, user so far); each account sees the
smallest of its users, each user hooks onto the smallest that any of its accounts saw, pointers are
shortened, and links of the users that were joined fall together.  Every user that still has a smaller
neighbour is joined to one, so the links shrink round by round, and chains need about as many rounds as
their length has digits in base two.  An account has at most ``most_devices`` links, so no join key is
hot; a user with many accounts is combined map-side.  Rounds are written tables; the driver only sees how
many users moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialize

MOST_DEVICES = 20


def sign_ins(events: DataFrame) -> DataFrame:
    """The distinct (user_pseudo_id, user_id) seen together; rows without either say nothing."""
    return events.where("user_pseudo_id IS NOT NULL AND user_id IS NOT NULL").select("user_pseudo_id", "user_id").distinct()


def without_hubs(links: DataFrame, most_devices: int = MOST_DEVICES) -> DataFrame:
    """Links of accounts that are on at most ``most_devices`` devices."""
    few = links.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= most_devices).select("user_id")
    return links.join(few, "user_id")


def _shortened(parents: DataFrame) -> DataFrame:
    """Every user's parent replaced by that one's parent."""
    above = parents.select(F.col("user").alias("parent"), F.col("parent").alias("_grand"))
    return parents.join(above, "parent", "left").select("user", F.coalesce("_grand", "parent").alias("parent"))


def stitched_users(links: DataFrame) -> DataFrame:
    """user_pseudo_id, stitched_id (the smallest user_pseudo_id of its component) of all devices in links."""
    users = materialize(links.select("user_pseudo_id", F.col("user_pseudo_id").alias("user")).distinct(), "stitched")
    open_links = materialize(links.select("user_id", F.col("user_pseudo_id").alias("user")).distinct(), "sign-ins")
    while True:
        seen = open_links.groupBy("user_id").agg(F.min("user").alias("_least"))
        hooked = open_links.join(seen, "user_id").groupBy("user").agg(F.min("_least").alias("parent"))
        parents = materialize(_shortened(_shortened(hooked)), "parents")
        if not parents.where("parent < user").count():
            return users.select("user_pseudo_id", F.col("user").alias("stitched_id"))
        moved = F.coalesce("parent", "user").alias("user")
        users = materialize(users.join(parents, "user", "left").select("user_pseudo_id", moved), "stitched")
        open_links = open_links.join(parents, "user").select("user_id", F.col("parent").alias("user")).distinct()
        # An account all of whose users are one by now joins nothing any more.
        still = open_links.groupBy("user_id").agg(F.min("user").alias("_a"), F.max("user").alias("_z")).where("_a < _z").select("user_id")
        open_links = materialize(open_links.join(still, "user_id", "left_semi"), "sign-ins")


def user_identity(events: DataFrame, most_devices: int = MOST_DEVICES) -> DataFrame:
    """int_user_identity: one row per device with its stitched user, the devices and the accounts of that user.

    Devices that never signed in, or only on hubs, are their own users.  Hub accounts aren't counted; events
    without a user_pseudo_id have no row.
    """
    links = materialize(without_hubs(sign_ins(events), most_devices), "links")
    found = stitched_users(links)
    accounts = (links.join(found, "user_pseudo_id").groupBy("stitched_id").agg(F.countDistinct("user_id").alias("accounts")))
    devices = events.where("user_pseudo_id IS NOT NULL").select("user_pseudo_id").distinct()
    named = devices.join(found, "user_pseudo_id", "left").select("user_pseudo_id", F.coalesce("stitched_id", "user_pseudo_id").alias("stitched_id"))
    sizes = named.groupBy("stitched_id").agg(F.count(F.lit(1)).alias("devices"))
    return (named.join(sizes, "stitched_id").join(accounts, "stitched_id", "left")
            .select("user_pseudo_id", "stitched_id", "devices", F.coalesce("accounts", F.lit(0)).cast("bigint").alias("accounts")))


def stitch(raw: DataFrame, identity: DataFrame) -> DataFrame:
    """Raw events whose ``user_pseudo_id`` is the stitched user, so that all models work on people instead of devices.

    Only devices that change their name go into the join; a hot device's events are on its streamed side.
    """
    renamed = identity.where("stitched_id <> user_pseudo_id").select("user_pseudo_id", "stitched_id")
    joined = raw.join(renamed, "user_pseudo_id", "left").withColumn("user_pseudo_id", F.coalesce("stitched_id", "user_pseudo_id"))
    return joined.select(*raw.columns)
