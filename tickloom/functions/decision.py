"""Decision rules over class probabilities (MOD-5 .. MOD-11, EVA-15) as column expressions.

Rows carry prob_down, prob_up, prob_flat; classes are 0 DOWN, 1 UP, 2 FLAT.
`risk=True` is the downside-risk mode, where only DOWN and FLAT are decided.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickloom.functions.numeric import any_of, as_col, clip, finite, flag

# Class codes.
DOWN, UP, FLAT = 0, 1, 2
LABELS = [DOWN, UP, FLAT]
LABEL_NAMES = {DOWN: "down", UP: "up", FLAT: "watch"}
PROBS = ["prob_down", "prob_up", "prob_flat"]

# Gates of the alert filter.
UP_CONFIDENCE = 0.64
DOWN_CONFIDENCE = 0.75
DOWN_CONFIDENCE_RISK = 0.68
RISK_SCORE_BOUND = 0.55
MIN_ALERT_RETURN = 0.01
RETURN_SIGNAL_BOUND = 0.003


def down_confidence_bound(risk: bool) -> float:
    return min(DOWN_CONFIDENCE, DOWN_CONFIDENCE_RISK) if risk else DOWN_CONFIDENCE


def normalized_probabilities(columns: list[str] | None = None) -> dict[str, Column]:
    """MOD-5: the three scores divided by their sum, one third each where the sum is 0."""
    columns = columns or PROBS
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0.0)))
    return {
        name: F.when(total > 0, F.coalesce(F.col(c), F.lit(0.0)) / total).otherwise(F.lit(1 / 3))
        for name, c in zip(PROBS, columns)
    }


def display_confidence() -> Column:
    """MOD-6: certainty of the top class, or the UP/DOWN gap when FLAT is on top; at most 0.95."""
    down, up, flat = (F.col(c) for c in PROBS)
    third = 1 / 3
    directional = 0.5 + 0.5 * clip((F.greatest(*PROBS) - third) / (1 - third), 0, 1)
    undecided = 0.5 + 0.5 * clip(F.abs(up - down), 0, 1)
    return clip(F.when(flat >= F.greatest(down, up), undecided).otherwise(directional), 0, 0.95)


def argmax_direction(risk: bool = True) -> Column:
    """MOD-7: most probable class, ties in the order DOWN, UP, FLAT; UP counts as FLAT in risk mode."""
    down, up, flat = (F.col(c) for c in PROBS)
    return (
        F.when((down >= up) & (down >= flat), DOWN)
        .when(up >= flat, FLAT if risk else UP)
        .otherwise(FLAT)
    )


def gated_direction(min_prob: Column | float, min_margin: Column | float, risk: bool = True) -> Column:
    """MOD-7: a direction only where its probability and its margin over FLAT pass the gate."""
    down, up, flat = (F.coalesce(F.col(c), F.lit(0.0)) for c in PROBS)
    if risk:
        return F.when((down >= min_prob) & (down - flat >= min_margin), DOWN).otherwise(FLAT)
    top = F.greatest(up, down)
    side = F.when(up >= down, UP).otherwise(DOWN)
    return F.when((top >= min_prob) & (top - flat >= min_margin), side).otherwise(FLAT)


def majority_direction(label: int, risk: bool = True) -> Column:
    """MOD-7: the fallback decision, always one class."""
    return F.lit(FLAT if risk and label == UP else label)


def signal_name(direction: Column | str) -> Column:
    return F.when(as_col(direction) == UP, "UP").when(as_col(direction) == DOWN, "DOWN").otherwise("WATCH")


def return_override(
    direction: Column, predicted_return: Column, bound: float = RETURN_SIGNAL_BOUND, risk: bool = True
) -> Column:
    """MOD-8: a clear predicted return overrides the class; 0 turns the rule off."""
    if bound <= 0:
        return direction
    value = finite(predicted_return)
    result = F.when(value <= -bound, DOWN)
    if not risk:
        result = result.when(value >= bound, UP)
    return result.otherwise(direction)


def _feature(name: str, columns: list[str], default: float = 0.0) -> Column:
    return finite(F.col(name), default) if name in columns else F.lit(default)


def downside_evidence(columns: list[str]) -> tuple[Column, Column]:
    """MOD-10: (risk score, number of evidence kinds 0..3) from the columns a frame has."""
    f = lambda name, default=0.0: _feature(name, columns, default)
    part = lambda value: clip(value, 0, 1)
    down = f("prob_down")
    fell = f("return_1") < 0
    weakness = F.greatest(
        part(-f("return_1") / 0.015), part(-f("return_3") / 0.030), part(-f("momentum_5") / 0.050)
    )
    volume = F.greatest(
        part(f("volume_down_breakout")), part(f("volume_ratio_20_raw", 1.0) - 1.0) * flag(fell)
    )
    relative = F.greatest(
        part(-f("relative_market_index_return_3") / 0.030),
        part(-f("relative_market_index_return_5") / 0.050),
        part(-f("sector_relative_return_5") / 0.050),
        part(-f("current_vs_market_index_return") / 0.020),
    )
    score = clip(
        part(down) * 0.34
        + part(down - f("prob_flat")) * 0.18
        + weakness * 0.18
        + volume * 0.12
        + relative * 0.18,
        0,
        1,
    )
    kinds = flag(weakness >= 0.20) + flag(volume >= 0.25) + flag(relative >= 0.20)
    return score, kinds.cast("int")


def alert_filter(columns: list[str], movement_threshold: float = 0.02, risk: bool = True) -> dict[str, Column]:
    """MOD-11: the alert signal and the four risk scores; use with `withColumns`."""
    signal = F.when(F.col("predicted_signal").isin("UP", "DOWN"), F.col("predicted_signal")).otherwise("WATCH")
    is_down = signal == "DOWN"
    confidence = _feature("confidence", columns)
    score, kinds = downside_evidence(columns)
    predicted = _feature("predicted_return", columns)
    weak = [
        (signal == "UP") & (confidence < UP_CONFIDENCE),
        is_down & (confidence < down_confidence_bound(risk)),
    ]
    has_return = "predicted_return" in columns
    if risk:
        strong = (score >= max(RISK_SCORE_BOUND + 0.12, 0.67)) & (kinds >= 2)
        if has_return:
            weak.append(is_down & (predicted > -MIN_ALERT_RETURN) & ~strong)
        weak.append(is_down & ((score < RISK_SCORE_BOUND) | (kinds < 1)))
    elif has_return:
        weak.append(is_down & (predicted > -abs(movement_threshold)))
    model_risk = clip(_feature("prob_down", columns), 0, 1)
    return {
        "predicted_signal": signal,
        "alert_signal": F.when(any_of(weak), "WATCH").otherwise(signal),
        "down_evidence_count": kinds if risk else F.lit(0),
        "model_risk_score": model_risk,
        "technical_risk_score": score if risk else F.lit(0.0),
        "sequence_risk_score": clip(_feature("sequence_risk_score", columns), 0, 1),
        "final_risk_score": score if risk else model_risk,
    }


def actual_signal(current: Column | str, actual: Column | str, bound: float = 0.02) -> Column:
    """EVA-15: what the price really did, strictly beyond the bound."""
    a, c = as_col(actual), as_col(current)
    return F.when(a > c * (1 + bound), "UP").when(a < c * (1 - bound), "DOWN").otherwise("WATCH")
