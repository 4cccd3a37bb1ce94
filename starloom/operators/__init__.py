"""The data jobs: frames in, a frame out."""
