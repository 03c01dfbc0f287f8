from loomfeed.plans.prepare import prepare_v1, prepare_v2, render_v1, render_v2

__all__ = ["prepare_v1", "prepare_v2", "render_v1", "render_v2"]
