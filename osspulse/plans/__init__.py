"""Models and questions: every function takes frames and returns a frame."""
