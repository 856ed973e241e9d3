from plumbline.streaming.monitor import daily_figures, judge_days, monitor_arrivals
from plumbline.streaming.watch import judged, take_in, watch

__all__ = ["daily_figures", "judge_days", "judged", "monitor_arrivals", "take_in", "watch"]
