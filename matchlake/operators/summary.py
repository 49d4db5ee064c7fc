"""Summary tables kept up by deltas: mergeable partials per key, corrections as a retraction and an insertion.

A summary holds sums, counts and maxima per key. When rows of its detail table are replaced, the old rows are taken
off and the new ones added; only keys of either are touched. Sums and counts merge. A maximum merges too, unless a
row that held it was taken off: it is then taken again from the detail rows of those keys alone. Distinct counts
become sums by choosing the detail's grain: one row per match and player for the matches of a player, one
summary row per team and season for the seasons of a team.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import metrics as m
from matchlake.operators import lines

ROWS = "_rows"


@dataclass(frozen=True)
class Summary:
    """Keys, sums and maxima of columns of a detail table. All sums are bigint or decimal, so they take off exactly."""

    keys: Sequence[str]
    sums: Sequence[str]
    peaks: Sequence[str] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [*self.keys, ROWS, *self.sums, *self.peaks]

    def partial(self, detail: DataFrame) -> DataFrame:
        """The summary of all detail rows."""
        return detail.groupBy(*self.keys).agg(
            F.count("*").alias(ROWS), *[F.sum(c).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.peaks]
        )

    def change(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """What replacing detail rows `old` by `new` changes, one row per touched key: differences of the sums, and the
        largest new and old value of each maximum. Combined before the shuffle."""
        used = [*self.keys, *self.sums, *self.peaks]
        rows = old.select(*used, F.lit(-1).alias("_sign")).unionByName(new.select(*used, F.lit(1).alias("_sign")))
        added = F.col("_sign") > 0
        return rows.groupBy(*self.keys).agg(
            F.sum("_sign").alias(ROWS),
            *[F.sum(F.when(added, F.col(c)).otherwise(-F.col(c))).alias(c) for c in self.sums],
            *[F.max(F.when(added, F.col(c))).alias(c) for c in self.peaks],
            *[F.max(F.when(~added, F.col(c))).alias(f"_gone_{c}") for c in self.peaks],
        )

    def merged(self, stored: DataFrame, change: DataFrame, detail: DataFrame) -> DataFrame:
        """The touched keys' new rows; a key without detail rows left has _rows 0. detail: the rows after the change,
        which are read only where a maximum was taken off."""
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys]
        both = change.alias("c").join(stored.alias("s"), same, "left")
        # Nothing is added to a sum that has no value on either side.
        plus = lambda c: F.coalesce(F.col(f"s.{c}") + F.col(f"c.{c}"), F.col(f"c.{c}"), F.col(f"s.{c}"))
        lost = F.lit(False)
        for c in self.peaks:
            gone = F.col(f"c._gone_{c}") >= F.col(f"s.{c}")
            lost = lost | m.is_true(gone & ~m.is_true(F.col(f"c.{c}") >= F.col(f"s.{c}")))
        out = both.select(
            *[F.col(f"c.{k}").alias(k) for k in self.keys],
            *[plus(c).alias(c) for c in (ROWS, *self.sums)],
            *[F.greatest(f"s.{c}", f"c.{c}").alias(c) for c in self.peaks],
            lost.alias("_lost"),
        )
        if not self.peaks:
            return out.drop("_lost")
        again = out.where("_lost").select(*self.keys)
        near = [F.col(f"d.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.keys]
        own = detail.alias("d").join(again.alias("k"), near, "left_semi")
        peaks = own.groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in self.peaks])
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"p.{k}")) for k in self.keys]
        met = out.alias("o").join(peaks.alias("p"), same, "left")
        fixed = {c: F.when(F.col("o._lost"), F.col(f"p.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in self.peaks}
        return met.select(*[fixed.get(c, F.col(f"o.{c}")) for c in self.columns])

    def replaced(self, stored: DataFrame, merged: DataFrame) -> DataFrame:
        """The whole summary after a change; keys without rows leave."""
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
        rest = stored.alias("s").join(merged.select(*self.keys).alias("n"), same, "left_anti")
        return rest.select(*self.columns).unionByName(merged.select(*self.columns)).where(F.col(ROWS) > 0)

    def agrees(self, stored: DataFrame, detail: DataFrame) -> bool:
        """Whether the summary's totals are those of its detail, as they are not after a run that died between
        the two."""
        totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in self.sums]
        left = stored.agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias(ROWS), *totals).first()
        return left == detail.agg(F.count("*").alias(ROWS), *totals).first()


# --- players --------------------------------------------------------------------------------------------------

CAREERS = Summary(
    ("player_name",),
    "bat_matches bat_innings runs balls fours sixes fifties centuries wickets economy_sum economy_count".split(),
    ("best_runs", "best_wickets"),
)


def player_lines(stg_balls: DataFrame) -> DataFrame:
    """One row per match and player: the detail of careers. Averages run over innings, so these come first."""
    innings = (
        lines.roles(stg_balls)
        .groupBy("match_id", "innings", "player", "team", "role")
        .agg(
            F.max("season").alias("season"),
            F.sum("runs_scored").alias("runs"),
            F.count("*").alias("balls"),
            m.count_where(m.is_four()).alias("fours"),
            m.count_where(m.is_six()).alias("sixes"),
            m.count_where(m.is_out()).alias("wickets"),
            F.max("_loaded_at").alias("_loaded_at"),
        )
        .withColumn("economy", m.economy_of_rounded_overs(F.col("runs"), F.col("balls")).cast("decimal(18,2)"))
    )
    bat, bowl = F.col("role") == lines.BAT, F.col("role") == lines.BOWL
    of = lambda role, c: F.sum(F.when(role, F.col(c)))
    batted = F.count(F.when(bat, F.col("runs")))
    return innings.groupBy("match_id", F.col("player").alias("player_name")).agg(
        F.max("season").alias("season"),
        F.when(F.count(F.when(bat, F.col("match_id"))) > 0, 1).otherwise(0).cast("bigint").alias("bat_matches"),
        batted.alias("bat_innings"),
        of(bat, "runs").alias("runs"),
        of(bat, "balls").alias("balls"),
        of(bat, "fours").alias("fours"),
        of(bat, "sixes").alias("sixes"),
        m.count_where(bat & (F.col("runs") >= 50)).alias("fifties"),
        m.count_where(bat & (F.col("runs") >= 100)).alias("centuries"),
        of(bowl, "wickets").alias("wickets"),
        of(bowl, "economy").alias("economy_sum"),
        F.count(F.when(bowl, F.col("economy"))).alias("economy_count"),
        F.max(F.when(bat, F.col("runs"))).alias("best_runs"),
        F.max(F.when(bowl, F.col("wickets"))).alias("best_wickets"),
        F.max("_loaded_at").alias("_loaded_at"),
    )


def dim_player(stg_players: DataFrame, careers: DataFrame) -> DataFrame:
    """The player dimension of `warehouse.dim_player` from the careers' partials."""
    mean = lambda total, n: F.round(F.try_divide(F.col(total).cast("double"), F.col(n).cast("double")), 2)
    shown = careers.where(F.col(ROWS) > 0).select(
        "player_name",
        F.col("bat_matches").alias("matches_played"),
        F.col("runs").alias("total_runs"),
        F.col("balls").alias("total_balls_faced"),
        F.col("fours").alias("total_fours"),
        F.col("sixes").alias("total_sixes"),
        F.col("best_runs").alias("highest_score"),
        mean("runs", "bat_innings").alias("batting_average"),
        m.strike_rate(F.col("runs"), F.col("balls")).alias("career_strike_rate"),
        "fifties",
        "centuries",
        F.col("wickets").alias("total_wickets"),
        mean("economy_sum", "economy_count").alias("career_economy"),
        F.col("best_wickets").alias("best_bowling_figures"),
    )
    kept = [c for c in shown.columns if c != "player_name"]
    about = "player_id player_name nationality date_of_birth batting_style bowling_style player_role ipl_debut_year".split()
    return stg_players.join(shown, "player_name", "left").select(
        *about, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in kept]
    )


# --- teams ----------------------------------------------------------------------------------------------------

TEAM_SEASONS = Summary(("team_name", "season"), ("wins",))


def team_lines(stg_matches: DataFrame) -> DataFrame:
    """One row per match and side: the detail of team seasons."""
    won = m.is_true(F.col("winner") == F.col("team")).cast("bigint")
    return lines.sides(stg_matches).select(F.col("team").alias("team_name"), "season", won.alias("wins"))


def team_record(team_seasons: DataFrame) -> DataFrame:
    """The record of `warehouse.team_record` from the seasons' partials."""
    agg = team_seasons.where(F.col(ROWS) > 0).groupBy("team_name").agg(
        F.sum(ROWS).alias("total_matches"),
        F.sum("wins").alias("total_wins"),
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.count("season").alias("seasons_played"),
    )
    return agg.select(
        "team_name",
        "total_matches",
        "total_wins",
        (F.col("total_matches") - F.col("total_wins")).alias("total_losses"),
        m.percent(F.col("total_wins"), F.col("total_matches")).alias("win_percentage"),
        "first_season",
        "last_season",
        "seasons_played",
    )
