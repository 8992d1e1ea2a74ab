"""frameline: Spark jobs over the control data, frames, objects, metrics and images of a media pipeline."""

from frameline.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
