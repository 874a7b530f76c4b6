"""lakenorm.sources"""
