"""SQL for ensemble weights and model selection."""

from __future__ import annotations

from tickloom.plans.oracle import cte, rnd

NAMES = [
    "balanced_direction_accuracy", "direction_macro_f1", "direction_lift_over_baseline", "down_recall", "down_precision",
    "predicted_down_ratio",
]
PICKS = [*NAMES, *[f"walk_forward_{n}" for n in NAMES], "alert_backtest_down_hit_rate", "alert_backtest_down_avg_inverse_return", "alert_backtest_up_avg_return"]
WIDE = f"SELECT model_version, model_name, {', '.join(f'''max(metric_value) FILTER (metric_name='{n}') AS {n}''' for n in PICKS)} FROM metrics GROUP BY ALL"
cte(
    "weight_scores",
    f"""SELECT *, CASE WHEN r<=0 OR cov<=0 THEN 0.005::DOUBLE ELSE greatest(0.005::DOUBLE, s*CASE WHEN cov<0.03 THEN 0.5 ELSE 1 END
        *CASE WHEN cov>0.6 THEN 0.35 WHEN cov>0.5 THEN 0.55 WHEN cov>0.42 THEN 0.75 ELSE 1 END) END AS raw
    FROM (SELECT *, walk_forward_down_recall AS r, walk_forward_predicted_down_ratio AS cov, walk_forward_direction_lift_over_baseline AS lift,
      walk_forward_down_recall*0.38::DOUBLE+walk_forward_down_precision*0.22::DOUBLE+walk_forward_balanced_direction_accuracy*0.16::DOUBLE+walk_forward_direction_macro_f1*0.1::DOUBLE
       +least(0.35,greatest(0,alert_backtest_down_hit_rate-0.35))*0.08::DOUBLE+least(0.08,greatest(0,alert_backtest_down_avg_inverse_return))*0.06::DOUBLE AS s FROM ({WIDE}))""",
    ["metrics"],
)
BUDGET = "0.15::DOUBLE"
cte(
    "weights",
    f"""SELECT model_version, model_name, w/sum(w) OVER (PARTITION BY model_version) AS weight FROM (
     SELECT *, coalesce(share, greatest(0.85::DOUBLE, 1-least(coalesce(sum(share) OVER (PARTITION BY model_version),0),{BUDGET}))) AS w FROM (
      SELECT *, CASE WHEN model_name<>'lightgbm' THEN least({BUDGET}*raw/sum(raw) FILTER (model_name<>'lightgbm') OVER (PARTITION BY model_version), cap) END AS share FROM (
       SELECT *, CASE model_name WHEN 'random_forest' THEN 0.05::DOUBLE WHEN 'lstm' THEN CASE WHEN lift<0 AND cov>greatest(0.5,0.42+0.08) THEN 0.0::DOUBLE
         WHEN cov>0.55 THEN 0.03::DOUBLE WHEN lift<=0 OR alert_backtest_down_avg_inverse_return<=0 THEN 0.05::DOUBLE ELSE 0.1::DOUBLE END END AS cap FROM weight_scores)))""",
    ["weight_scores"],
)
WEIGHTS_SQL = f"SELECT model_version, model_name, {rnd('weight', 6)} AS weight FROM weights WHERE weight>0"
BEST_SQL = f"""SELECT model_version, model_name, {rnd('q', 6)} AS quality FROM (SELECT *, s-CASE WHEN lift<0 THEN least(abs(lift),0.3)*0.35 ELSE 0 END AS q FROM (
  SELECT *, walk_forward_direction_lift_over_baseline AS lift, walk_forward_balanced_direction_accuracy*0.35::DOUBLE+walk_forward_direction_macro_f1*0.25::DOUBLE
   +balanced_direction_accuracy*0.2::DOUBLE+direction_macro_f1*0.1::DOUBLE+greatest(walk_forward_direction_lift_over_baseline,-0.5)*0.05::DOUBLE-0.05::DOUBLE*0.05::DOUBLE
   +least(alert_backtest_down_avg_inverse_return,0)*5+least(0.02,greatest(0,alert_backtest_up_avg_return))*3 AS s FROM ({WIDE})))
  QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY CASE WHEN lift>0 THEN 0 ELSE 1 END, {rnd('q', 9)} DESC, list_position(['lightgbm','lstm','random_forest'],model_name))=1"""
