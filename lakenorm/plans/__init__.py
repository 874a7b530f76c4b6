"""lakenorm.plans"""
