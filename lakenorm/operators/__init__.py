"""lakenorm.operators"""
