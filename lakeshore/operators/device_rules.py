"""User agent -> device label by a table of rules.

A rule names a literal token, so the rules form an inverted index: an agent's
tokens (its runs of letters and digits in lower case) are joined with the rules'
tokens, which leaves the few candidates whose pattern is tried.  Of the rules
that match the lowest priority wins.  Each distinct agent is labelled once,
whatever number of log lines carries it.

Rules (RULE_COLUMNS): ``token`` in lower case, NULL or empty for a rule that is
tried on every agent (keep those few); ``pattern`` a regular expression that must be
found in the agent; ``family``, ``brand``, ``model`` texts in which ``{1}``
stands for the pattern's first group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.useragent import UNKNOWN_DEVICE

RULE_COLUMNS = "priority int, token string, pattern string, family string, brand string, model string"
_GROUP = "{1}"


def agent_tokens(agent: Column) -> Column:
    """Distinct tokens of an agent; the empty token, which every agent has, comes with them."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(agent), "[^a-z0-9]+")))


def _filled(text: Column, agent: Column, pattern: Column) -> Column:
    """The text with the pattern's first group for ``{1}`` (the group is only asked for where it is used)."""
    group = F.call_function("regexp_extract", agent, pattern, F.lit(1))
    return F.when(F.contains(text, F.lit(_GROUP)), F.replace(text, F.lit(_GROUP), group)).otherwise(text)


def label_agents(agents: DataFrame, rules: DataFrame, agent_col: str = "user_agent") -> DataFrame:
    """(agent, device) for each distinct agent; no rule matches -> ``Other None None``; NULL agents give no row.

    Of matching rules with one priority the smallest pattern, then label, wins.
    """
    names = agents.select(F.col(agent_col).alias("agent")).where(F.col("agent").isNotNull()).distinct()
    index = rules.where(F.col("pattern").isNotNull()).select(
        F.lower(F.coalesce("token", F.lit(""))).alias("token"), "priority", "pattern", "family", "brand", "model")
    tokens = names.select("agent", F.explode(agent_tokens(F.col("agent"))).alias("token"))
    agent, pattern = F.col("agent"), F.col("pattern")
    label = F.concat_ws(" ", *[_filled(F.col(c), agent, pattern) for c in ("family", "brand", "model")])
    hits = (tokens.join(index, "token").where(F.regexp_like(agent, pattern))
            .groupBy("agent").agg(F.min(F.struct("priority", "pattern", label.alias("label"))).alias("best")))
    return names.join(hits, "agent", "left").select("agent", F.coalesce("best.label", F.lit(UNKNOWN_DEVICE)).alias("device"))


def with_device(df: DataFrame, rules: DataFrame, agent_col: str = "user_agent", out_col: str = "device") -> DataFrame:
    """``df`` with the device of each row's agent (NULL for a NULL agent); rows are kept as they are."""
    labels = label_agents(df, rules, agent_col).select(F.col("agent").alias("_agent"), F.col("device").alias("_device"))
    kept = [c for c in df.columns if c != out_col]
    joined = df.join(labels, F.col(agent_col) == F.col("_agent"), "left")
    return joined.select(*kept, F.col("_device").alias(out_col))
