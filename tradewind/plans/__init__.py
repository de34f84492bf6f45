"""Jobs: frames in, frame out."""
