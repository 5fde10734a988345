"""Blogger payment marts: summary (Q1), detail (Q2), summary v2 (Q3).

Inputs (staging tables):
    posts   author, release_date, tiktok_reach, tiktok_video_link, youtube_reach,
            instagram_reach, likee_video_link, likee_reach, account_name, sheets_name
    roster  blogger ('Last First [Patronymic]'), region, currency, grade, is_state, contract
    kpi     premium brackets: grade, currency, start_reach, end_reach, tiktok, instagram,
            youtube, likee
    price   price brackets: grade, currency, start_count, end_count, price

Semantics kept on purpose (they are what the mart has always reported):
    * the per-post rows are re-joined to the per-account aggregate on the
      person (and month) only, so every post pairs with every account of its
      blogger; the summary's price is summed over those pairs;
    * a missing premium bracket gives 0, a missing price bracket gives a NULL
      price and therefore a NULL total;
    * overlapping brackets multiply rows.

``month=None`` runs every month at once: each month is computed exactly as a
single-month run (month is part of every join key), so the result is the
union of all monthly runs, i.e. what the mart holds after loading each month.

Plan shape.  The fan-out join (posts x accounts) is never materialised for
the summaries: the posts are scanned once and aggregated, and the join
multiplies aggregates (sum over pairs = per-post sum x number of partner
rows).  Premium brackets are looked up as non-overlapping intervals (match
count + sums), so overlapping brackets are counted without repeating rows.
All shuffles carry partial aggregates, so a blogger holding a third of all
posts costs no skew.  The roster and the bracket sheets are broadcast behind
a size check; the fact table is never shuffled for a lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.text import int_from_text, strip_word
from vitrina.operators.aggs import capped_count, count_if
from vitrina.operators.brackets import elementary_intervals, interval_lookup
from vitrina.operators.broadcast import BRACKET_MAX_BYTES, ROSTER_MAX_BYTES, fits
from vitrina.operators.joins import bracket_join, name_key_join, person_keys, skew_join
from vitrina.session import materialize

# Fixed values of the payment marts.
REPORT_WORD = "Отчет"          # stripped from account names
SPECIAL_LOCATION = "дубай"     # special-location link, compared lower-cased
STAFF_FLAG = "TRUE"
STAFF_LABEL = "штат"
LINK_PREFIX = "http"
DEFAULT_CAP = 60               # paid links per blogger and month before the bonus rule

PERSON = ["first_name", "last_name"]
MONTH = "sheets_name"
REACHES = ["tiktok_reach", "youtube_reach", "instagram_reach", "likee_reach"]

SUMMARY_COLUMNS = ["blogger_name", "account_name", "grade", "currency", "video_count",
                   "price_count_videos", "instagram_count", "youtube_count", "tiktok_premium",
                   "likee_premium", "instagram_premium", "youtube_premium", "sheets_name",
                   "sum_count"]
DETAIL_COLUMNS = ["blogger_name", "account_name", "grade", "release_date", "currency",
                  "video_count", "price_per_video", "tiktok_video_link", "tiktok_reach",
                  "likee_video_link", "likee_reach", "instagram_count", "youtube_count",
                  "tiktok_premium", "likee_premium", "instagram_premium", "youtube_premium",
                  "sheets_name"]
SUMMARY_V2_COLUMNS = ["blogger_name", "state", "grade", "currency", "real_tiktok_link_count",
                      "payment_tiktok_link_count", "dubai_count", "price_count_videos",
                      "price_count_dubai_videos", "all_price_video", "instagram_count",
                      "youtube_count", "tiktok_premium", "likee_premium", "instagram_premium",
                      "youtube_premium", "sheets_name", "sum_count"]


class Brackets:
    """The two bracket sheets, pruned and size-checked once per plan."""

    def __init__(self, kpi: DataFrame, price: DataFrame):
        self.kpi = kpi.select("grade", "currency", "start_reach", "end_reach",
                              "tiktok", "instagram", "youtube", "likee")
        self.price = price.select("grade", "currency", "start_count", "end_count", "price")
        self.kpi_bc = fits(self.kpi, BRACKET_MAX_BYTES)
        self.price_bc = fits(self.price, BRACKET_MAX_BYTES)
        # premium sheet as non-overlapping intervals (match count + premium sums)
        self.kpi_iv = elementary_intervals(self.kpi, "start_reach", "end_reach",
                                           ["tiktok", "likee"])

    def premium(self, df: DataFrame, measure: str, column: str, out: str) -> DataFrame:
        return bracket_join(df, self.kpi, measure, "start_reach", "end_reach", {column: out},
                            broadcast=self.kpi_bc)

    def price_for(self, df: DataFrame, count: str, out: str = "price") -> DataFrame:
        return bracket_join(df, self.price, count, "start_count", "end_count", {"price": out},
                            broadcast=self.price_bc, coalesce=False)

    def post_premium_sums(self, stats: DataFrame) -> DataFrame:
        """Per post, without repeating it: k1/s1 = tiktok brackets matched and
        their premium sum, k2/s2 the same for likee.  The SQL's per-post rows
        number max(k1,1)*max(k2,1); their tiktok premiums sum to
        max(k2,1)*s1 and their likee premiums to max(k1,1)*s2."""
        x = interval_lookup(stats, self.kpi_iv, "tiktok_reach", {"tiktok": "_s1"}, "_k1",
                            broadcast=self.kpi_bc)
        x = interval_lookup(x, self.kpi_iv, "likee_reach", {"likee": "_s2"}, "_k2",
                            broadcast=self.kpi_bc)
        k1, k2 = F.greatest(F.col("_k1"), F.lit(1)), F.greatest(F.col("_k2"), F.lit(1))
        return x.select(*stats.columns, (k1 * k2).alias("_rows"),
                        (k2 * F.col("_s1")).alias("_tiktok"), (k1 * F.col("_s2")).alias("_likee"))


def month_slice(posts: DataFrame, month: str | None) -> DataFrame:
    """Equality filter on the report month (pushed into the scan)."""
    return posts if month is None else posts.where(F.col(MONTH) == F.lit(month))


def payment_stats(posts: DataFrame, roster: DataFrame, month: str | None = None) -> DataFrame:
    """Posts of one month (or all) with person keys, joined to the roster,
    reach text turned into int ('' and NULL are 0; garbage fails)."""
    keyed = person_keys(month_slice(posts, month)).drop("author")
    j = name_key_join(keyed, roster)
    # cast after the join: rows without a roster match are never parsed
    return j.select(*PERSON, "release_date",
                    *[int_from_text(c).alias(c) for c in REACHES],
                    "tiktok_video_link", "likee_video_link", "account_name", MONTH,
                    "region", "currency", "grade", "is_state", "contract")


def post_premiums(stats: DataFrame, br: Brackets) -> DataFrame:
    """Per-post premium rows: tiktok premium by tiktok reach, likee premium by likee reach."""
    x = br.premium(stats, "tiktok_reach", "tiktok", "tiktok_premium")
    return br.premium(x, "likee_reach", "likee", "likee_premium")


def account_totals(stats: DataFrame) -> DataFrame:
    """Links and reach totals per person, grade, currency, month and account."""
    link = F.col("tiktok_video_link")
    return stats.groupBy(*PERSON, "grade", "currency", MONTH, "account_name").agg(
        count_if(link.isNotNull() & (link != "")).alias("video_count"),
        F.sum("instagram_reach").alias("instagram_count"),
        F.sum("youtube_reach").alias("youtube_count"))


def account_prices(totals: DataFrame, br: Brackets) -> DataFrame:
    """Price by link count, instagram / youtube premium by their totals."""
    x = br.price_for(totals, "video_count")
    x = br.premium(x, "instagram_count", "instagram", "instagram_premium")
    return br.premium(x, "youtube_count", "youtube", "youtube_premium")


def in_month_order(posts: DataFrame) -> DataFrame:
    """Posts in tasks of about one month each, ordered by it; those without a month, which meet no
    account, have ''.

    A table written by month wants this order.  A broadcast join keeps it, so the posts are sorted and not
    the pairs, which are several times as many.  The filter, true for every row, keeps the optimizer
    from dropping the order (it holds that a join needs none), and a month that is never NULL is written as it is."""
    dealt = posts.withColumn(MONTH, F.coalesce(MONTH, F.lit(""))).hint("rebalance", F.col(MONTH))
    return dealt.sortWithinPartitions(MONTH).where(F.monotonically_increasing_id() >= 0)


class PaymentPlan:
    """The payment marts of one month (or all months) over shared inputs.

    The posts are
    aggregated once, at the finest grain any mart needs (person, grade,
    currency, month, account, staff flag, contract), into ``accounts``: link
    counts, reach totals, and the number of per-post premium rows with their
    premium sums.  That table is small and is written once to the shared
    checkpoint folder; the summary, the v2 summary and the detail's
    per-account side are roll-ups of it, so a load of both marts reads the
    posts twice (once here, once for the detail's per-post rows).
    """

    GRAIN = [*PERSON, "grade", "currency", MONTH, "account_name", "is_state", "contract"]

    def __init__(self, posts: DataFrame, roster: DataFrame, kpi: DataFrame, price: DataFrame,
                 month: str | None = None, share: bool = True):
        self.br = Brackets(kpi, price)
        self.stats = payment_stats(posts, roster, month)
        self.share = share     # False: a lone detail keeps its account side inline
        self._accounts: DataFrame | None = None
        self._kept = False
        self.dealt = False     # whether the detail's rows come in tasks of about one month each

    def keep(self) -> PaymentPlan:
        """Write the joined and parsed posts once, for plans that read them several times."""
        if not self._kept:
            self.stats, self._kept = materialize(self.stats, "stats"), True
        return self

    def accounts(self) -> DataFrame:
        if self._accounts is None:
            link = F.col("tiktok_video_link")
            real, special = _link_aggs(link)
            if not self.br.kpi_bc:  # the block lookups read the posts' measures too
                self.keep()
            self._accounts = materialize(
                self.br.post_premium_sums(self.stats).groupBy(*self.GRAIN).agg(
                    count_if(link.isNotNull() & (link != "")).alias("video_count"),
                    real.alias("_real"), special.alias("_special"),
                    F.sum("instagram_reach").alias("instagram_count"),
                    F.sum("youtube_reach").alias("youtube_count"),
                    F.sum("_rows").alias("_rows"), F.sum("_tiktok").alias("_tiktok"),
                    F.sum("_likee").alias("_likee")), "accounts")
        return self._accounts

    def account_level(self) -> DataFrame:
        """Per (person, grade, currency, month, account): the A2 totals and premium sums."""
        return self.accounts().groupBy(*PERSON, "grade", "currency", MONTH, "account_name").agg(
            *[F.sum(c).alias(c) for c in ("video_count", "instagram_count", "youtube_count",
                                          "_rows", "_tiktok", "_likee")])

    def account_prices(self) -> DataFrame:
        cols = [*PERSON, "grade", "currency", MONTH, "account_name", "video_count",
                "instagram_count", "youtube_count"]
        totals = (self.account_level() if self.share or self._accounts is not None
                  else account_totals(self.stats)).select(*cols)
        return account_prices(totals, self.br)

    def detail_rows(self) -> DataFrame:
        """Per post x per account of the same blogger (and month): the fan-out join."""
        tp = post_premiums(self.stats, self.br).drop("account_name")
        vp = self.account_prices().select(*PERSON, MONTH, "account_name", "video_count",
                                          "instagram_count", "youtube_count", "price",
                                          "instagram_premium", "youtube_premium")
        return tp.join(vp, [*PERSON, MONTH])

    def detail(self, by_month: bool = False) -> DataFrame:
        """Q2: distinct published videos with their account's count, price and premiums.

        Both sides are made distinct on the columns they give before the fan-out (a
        name part holds no blank, so the two-blank name stands for the person):
        pairs of distinct rows are distinct, and the shuffle carries posts, not pairs.
        ``by_month``: for a table with a folder for each month; ``dealt`` then tells whether the
        posts were dealt by month before the pairs were made, so that these need no exchange.
        """
        posts = (post_premiums(self.stats.where(F.col("tiktok_video_link") != ""), self.br)
                 .select(*PERSON, "grade", "release_date", "currency", "tiktok_video_link",
                         "tiktok_reach", "likee_video_link", "likee_reach", "tiktok_premium",
                         "likee_premium", MONTH).distinct())
        name = F.concat(F.col("first_name"), F.lit("  "), F.col("last_name"))  # once an account, not once a pair
        accounts = (self.account_prices()
                    .select(*PERSON, MONTH, name.alias("blogger_name"),
                            strip_word("account_name", REPORT_WORD).alias("account_name"),
                            "video_count", "instagram_count", "youtube_count", "price",
                            "instagram_premium", "youtube_premium").distinct())
        return self._paired(posts, accounts, by_month).select(
            "blogger_name", "account_name", "grade", "release_date", "currency", "video_count",
            F.col("price").alias("price_per_video"),
            "tiktok_video_link", "tiktok_reach", "likee_video_link", "likee_reach",
            "instagram_count", "youtube_count", "tiktok_premium", "likee_premium",
            "instagram_premium", "youtube_premium", MONTH)

    def _paired(self, posts: DataFrame, accounts: DataFrame, by_month: bool) -> DataFrame:
        """Posts with the accounts of their person and month.  The accounts are written, so their size is
        known: few are broadcast, and the posts are not shuffled for the join.  Where they are too many,
        bloggers with many posts are dealt."""
        keys = [*PERSON, MONTH]
        accounts = materialize(accounts, "account-prices")
        if fits(accounts, ROSTER_MAX_BYTES):
            self.dealt = by_month
            return (in_month_order(posts) if by_month else posts).join(F.broadcast(accounts), keys)
        if self._accounts is None:
            return posts.join(accounts, keys)
        counts = self.accounts().groupBy(*keys).agg(F.sum("_rows").alias("n"))
        return skew_join(posts, accounts, keys, counts=counts)

    def summary(self) -> DataFrame:
        """Q1: one row per blogger, grade, currency, month and account.

        Equals grouping the fan-out rows (per-post rows x account rows of the
        same person and month) by (person, post grade, post currency, account
        counts, month, account) with SUM(price), SUM of the post premiums and
        MAX of the account premiums, computed without the fan-out:
            T: accounts rolled up to (person, grade, currency, month);
            V: account counts priced, per (person, month, account, counts);
        joined on (person, month): SUM(price) = post rows x price sum and
        SUM(post premium) = premium sum x account rows.
        """
        g = self.account_level()
        t = (g.groupBy(*PERSON, "grade", "currency", MONTH)
              .agg(F.sum("_rows").alias("_n_posts"), F.sum("_tiktok").alias("_tiktok"),
                   F.sum("_likee").alias("_likee")))
        v = (self.account_prices()
             .groupBy(*PERSON, MONTH, "account_name", "video_count", "instagram_count",
                      "youtube_count")
             .agg(F.sum("price").alias("_price"),
                  F.count(F.lit(1)).alias("_n_rows"),
                  F.max("instagram_premium").alias("instagram_premium"),
                  F.max("youtube_premium").alias("youtube_premium")))
        j = t.join(v, [*PERSON, MONTH])
        price_count = (F.col("_n_posts") * F.col("_price")).alias("price_count_videos")
        tiktok = (F.col("_tiktok") * F.col("_n_rows")).alias("tiktok_premium")
        likee = (F.col("_likee") * F.col("_n_rows")).alias("likee_premium")
        out = j.select(
            F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("blogger_name"),
            strip_word("account_name", REPORT_WORD).alias("account_name"),
            "grade", "currency", "video_count", price_count, "instagram_count", "youtube_count",
            tiktok, likee, "instagram_premium", "youtube_premium", MONTH)
        total = (F.col("price_count_videos") + F.col("tiktok_premium") + F.col("likee_premium")
                 + F.col("instagram_premium") + F.col("youtube_premium"))
        return out.withColumn("sum_count", total)

    def summary_v2(self, cap: int = DEFAULT_CAP) -> DataFrame:
        """Q3: per blogger and month, with the link cap, the special-location
        bonus and the staff / contract label; same roll-up plan as Q1."""
        g = self.accounts()
        t = (g.groupBy(*PERSON, "grade", "currency", MONTH, "is_state", "contract")
              .agg(F.sum("_tiktok").alias("_tiktok"), F.sum("_likee").alias("_likee")))
        vc = capped(g.groupBy(*PERSON, "grade", "currency", MONTH).agg(
            F.sum("_real").alias("real_tiktok_link_count"), F.sum("_special").alias("dubai_count"),
            F.sum("instagram_count").alias("instagram_count"),
            F.sum("youtube_count").alias("youtube_count")), cap)
        br = self.br
        vp = br.price_for(vc, "payment_tiktok_link_count")
        vp = br.premium(vp, "instagram_count", "instagram", "instagram_premium")
        vp = br.premium(vp, "youtube_count", "youtube", "youtube_premium")
        v = (vp.groupBy(*PERSON, MONTH, "real_tiktok_link_count", "payment_tiktok_link_count",
                        "dubai_count", "instagram_count", "youtube_count", "price")
               .agg(F.count(F.lit(1)).alias("_n_rows"),
                    F.max("instagram_premium").alias("instagram_premium"),
                    F.max("youtube_premium").alias("youtube_premium")))
        j = t.join(v, [*PERSON, MONTH])
        pcv = F.col("price") * F.col("payment_tiktok_link_count")
        pcd = F.col("price") * F.col("dubai_count")
        tiktok = F.col("_tiktok") * F.col("_n_rows")
        likee = F.col("_likee") * F.col("_n_rows")
        return j.select(
            F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("blogger_name"),
            F.when(F.col("is_state") == STAFF_FLAG, F.lit(STAFF_LABEL))
             .otherwise(F.col("contract")).alias("state"),
            "grade", "currency", "real_tiktok_link_count", "payment_tiktok_link_count",
            "dubai_count", pcv.alias("price_count_videos"), pcd.alias("price_count_dubai_videos"),
            (pcv + pcd).alias("all_price_video"), "instagram_count", "youtube_count",
            tiktok.alias("tiktok_premium"), likee.alias("likee_premium"),
            "instagram_premium", "youtube_premium", MONTH,
            (pcv + pcd + tiktok + likee + F.col("instagram_premium") + F.col("youtube_premium"))
            .alias("sum_count"))


def _link_aggs(link):
    return (count_if(link.startswith(LINK_PREFIX)), count_if(F.lower(link) == SPECIAL_LOCATION))


def link_counts(stats: DataFrame, cap: int = DEFAULT_CAP) -> DataFrame:
    """v2 counts per person, grade, currency, month: real links (``http`` prefix),
    special-location links, paid links (capped: above ``cap`` it is cap + special)."""
    real, special = _link_aggs(F.col("tiktok_video_link"))
    g = stats.groupBy(*PERSON, "grade", "currency", MONTH).agg(
        real.alias("real_tiktok_link_count"), special.alias("dubai_count"),
        F.sum("instagram_reach").alias("instagram_count"),
        F.sum("youtube_reach").alias("youtube_count"))
    return capped(g, cap)


def capped(counts: DataFrame, cap: int) -> DataFrame:
    return counts.select(
        *PERSON, "grade", "currency", MONTH, "real_tiktok_link_count",
        capped_count(F.col("real_tiktok_link_count"), F.col("dubai_count"), cap)
        .alias("payment_tiktok_link_count"),
        "dubai_count", "instagram_count", "youtube_count")


def detail_rows(posts: DataFrame, roster: DataFrame, kpi: DataFrame, price: DataFrame,
                month: str | None = None) -> DataFrame:
    return PaymentPlan(posts, roster, kpi, price, month, share=False).detail_rows()


def payment_detail(posts: DataFrame, roster: DataFrame, kpi: DataFrame, price: DataFrame,
                   month: str | None = None) -> DataFrame:
    """Q2 (see ``PaymentPlan.detail``)."""
    return PaymentPlan(posts, roster, kpi, price, month, share=False).detail()


def payment_summary(posts: DataFrame, roster: DataFrame, kpi: DataFrame, price: DataFrame,
                    month: str | None = None) -> DataFrame:
    """Q1 (see ``PaymentPlan.summary``)."""
    return PaymentPlan(posts, roster, kpi, price, month).summary()


def payment_summary_v2(posts: DataFrame, roster: DataFrame, kpi: DataFrame, price: DataFrame,
                       month: str | None = None, cap: int = DEFAULT_CAP) -> DataFrame:
    """Q3 (see ``PaymentPlan.summary_v2``)."""
    return PaymentPlan(posts, roster, kpi, price, month).summary_v2(cap)
