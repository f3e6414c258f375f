from ladderlake.streaming.incremental import load_new_files, unloaded_files
from ladderlake.streaming.resume import resume_points, track_pages

__all__ = ["load_new_files", "resume_points", "track_pages", "unloaded_files"]
