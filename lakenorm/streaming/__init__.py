"""lakenorm.streaming"""
