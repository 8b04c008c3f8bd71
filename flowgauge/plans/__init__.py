"""Models (staging and marts), the model builder and the daily pipeline."""
