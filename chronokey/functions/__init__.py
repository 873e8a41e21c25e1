from chronokey.functions.time import duration_us, epoch_us, from_epoch_us, window_floor

__all__ = ["duration_us", "epoch_us", "from_epoch_us", "window_floor"]
